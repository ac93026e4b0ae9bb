"""Text functions as column expressions; all run inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Punctuation, brackets and spaces that names are compared without.
NAME_NOISE = r"""[\s()\[\]{}<>"'`“”‘’《》（）【】·、,，.。:：;；!！?？—–_/\\-]"""
#: Pattern of e-mail addresses and of phone numbers.
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
PHONE = r"(?<!\d)(?:\+?86[- ]?)?1\d{10}(?!\d)|(?<!\d)0\d{2,3}[- ]?\d{7,8}(?!\d)"
SHORT_PHONE = r"(?:电话|联系方式|老师)[：: \t]*(?:联系方式[：: \t]*)?([1-9]\d{6,7})(?!\d)"
HALF = "".join(chr(c) for c in range(0x21, 0x7F))
FULL = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))


def normal_name(c: Column) -> Column:
    """Lower case without brackets, quotes, spaces and marks."""
    return F.regexp_replace(F.lower(c), NAME_NOISE, "")


def title_key(c: Column, prefixes: str = r"^\s*[\[【(（]?(?:repost|fwd|转发|转)[\]】)）]?\s*[:：]?\s*") -> Column:
    """Without a repost mark in front, then without spaces and quotes; case is kept."""
    return F.regexp_replace(F.regexp_replace(c, "(?i)" + prefixes, ""), r"""[\s"'“”‘’「」『』]""", "")


def half_width(c: Column) -> Column:
    return F.translate(F.translate(c, FULL, HALF), "　", " ")


def search_text(c: Column) -> Column:
    """Half width, lower case, without punctuation and white space: what searches compare."""
    return F.regexp_replace(F.lower(half_width(c)), r"[\p{Punct}\s，。、；：！？（）《》“”‘’【】—·]", "")


def haystack(*parts: Column) -> Column:
    return search_text(F.concat_ws(" ", *parts))


def match_score(c: Column, query: Column) -> Column:
    """2: the text holds the query; 1: it holds its characters in order (two at least); 0: neither. Empty: 2."""
    text, q = search_text(c), search_text(query)
    quoted = F.transform(F.split(q, ""), lambda x: F.regexp_replace(x, r"([%_\\])", r"\\$1"))
    ordered = F.concat(F.lit("%"), F.array_join(F.filter(quoted, lambda x: x != ""), "%"), F.lit("%"))
    return F.when(F.length(q) == 0, 2).when(F.contains(text, q), 2).when((F.length(q) >= 2) & F.like(text, ordered), 1).otherwise(0)


def contains_any(c: Column, keywords: list[str]) -> Column:
    return F.coalesce(reduce(lambda a, b: a | b, (F.contains(c, F.lit(k)) for k in keywords)), F.lit(False))


def allow_deny(c: Column, allow: str, deny: str) -> Column:
    """Matches the first pattern and not the second; null is false."""
    return F.coalesce(c.rlike(allow) & ~c.rlike(deny), F.lit(False))


def classify(c: Column, taxonomy: list[tuple[str, list[str]]], other: str) -> Column:
    """First category, in order, of which the text holds a keyword."""
    out = F.lit(other)
    for category, keywords in reversed(taxonomy):
        out = F.when(contains_any(c, keywords), category).otherwise(out)
    return out


def excerpt(c: Column, size: int = 480, marks: tuple[str, ...] = ("。", "！", "？", ".", "!", "?"), least: float = 0.55) -> Column:
    """The first `size` characters, cut behind the last mark (the first kind that stands far enough in), or with an
    ellipsis; shorter texts as they are."""
    head = F.substring(c, 1, size)
    out = F.concat(head, F.lit("…"))
    for mark in reversed(marks):
        last = F.length(head) - F.locate(mark, F.reverse(head)) + 1
        out = F.when((F.locate(mark, head) > 0) & (last >= size * least), F.substring(head, F.lit(1), last)).otherwise(out)
    return F.when(F.length(c) <= size, c).otherwise(out)


def head_excerpt(c: Column, size: int = 480) -> Column:
    return F.when(F.length(c) > size, F.concat(F.substring(c, 1, size), F.lit("…"))).otherwise(c)


def sentences(c: Column, marks: str = r"[。；;.\n]") -> Column:
    """Trimmed parts between marks, empty ones left out."""
    return F.filter(F.transform(F.split(c, marks), lambda x: F.trim(x)), lambda x: x != "")


def emails(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(EMAIL), 0)


def phones(c: Column) -> Column:
    """Mobile numbers and those with an area code, then labelled short ones, each once."""
    return F.array_union(F.regexp_extract_all(c, F.lit(PHONE), 0), F.regexp_extract_all(c, F.lit(SHORT_PHONE), 1))


def clean_tags(c: Column) -> Column:
    """Without tags, with the five basic entities and white space put right."""
    out = F.regexp_replace(c, r"<[^>]*>", "")
    for name, text in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(text))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def html_title(c: Column) -> Column:
    return F.regexp_extract(c, r"<title>([^<]*)</title>", 1)


def hrefs(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r'href="([^"]*)"'), 1)


def url_key(c: Column) -> Column:
    """Trimmed, lower case, without scheme, www. and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"^https?://(www\.)?", ""), r"/+$", "")


def url_part(c: Column, part: str) -> Column:
    patterns = {"scheme": r"^([a-z]+)://", "host": r"^[a-z]+://([^/?#]*)", "path": r"^[a-z]+://[^/?#]*([^?#]*)", "query": r"\?([^#]*)", "fragment": r"#(.*)$"}
    return F.regexp_extract(c, patterns[part], 1)


def absolute_url(base: Column, link: Column) -> Column:
    """The link seen from the base, if that is http(s), else empty."""
    root = F.regexp_extract(base, r"^(https?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^(https?://[^?#]*/)", 1)
    made = F.when(link.rlike(r"^https?://"), link).when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^(https?:)", 1), link)).when(link.startswith("/"), F.concat(root, link)).when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.lit("")).otherwise(F.concat(folder, link))
    return F.when(made.rlike(r"^https?://[^/]+"), made).otherwise(F.lit(""))


def despace_cjk(c: Column) -> Column:
    return F.regexp_replace(c, r"(?<=[\p{IsHan}])\s+(?=[\p{IsHan}])", "")


def html_escape(c: Column) -> Column:
    for plain, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(plain), F.lit(name))
    return c


def content_hash(*parts: Column) -> Column:
    """sha256 of the parts as one JSON object."""
    return F.sha2(F.to_json(F.struct(*parts)), 256)


def identity_key(c: Column) -> Column:
    """Without white space and quotes; case and other marks are kept."""
    return F.regexp_replace(c, r"[\s“”\"‘’]", "")


def classifier_key(c: Column) -> Column:
    """Lower case without white space, quotes, brackets and dashes."""
    return F.lower(F.regexp_replace(c, r"[\s“”\"（）()·—-]", ""))


def title_match_key(c: Column) -> Column:
    """A title as it is compared with keywords: without quotes, brackets, middle dots, hyphens and white space."""
    return F.regexp_replace(c, r"[“”\"'（）()·\-\s]", "")


def clean_spaces(c: Column) -> Column:
    """Runs of blanks of any width as one, ends trimmed; line feeds stay."""
    return F.trim(F.regexp_replace(F.translate(c, " 　", "  "), r"[ \t\r\f\x0B]+", " "))


def mended_url(c: Column) -> Column:
    """A URL fragment of scanned text as it was probably meant; only for candidates."""
    out = F.regexp_replace(F.translate(c, "：·。", ":.."), r"\s+", "")
    out = F.replace(F.replace(out, F.lit("https:/"), F.lit("https://")), F.lit("http:/"), F.lit("http://"))
    out = F.regexp_replace(out, r"^https?://+", "https://")
    return F.regexp_replace(out, r"\.(edu|com|org|net|gov)/(cn|com|org|net|gov)\b", ".$1.$2")


def article_url(c: Column, host: str, keys: tuple[str, ...]) -> Column:
    """The one form of an article's URL at the host: by path where there is one, else by its query parameters in a fixed
    order; null for another host or scheme, or where a parameter is missing."""
    values = [F.regexp_extract(c, rf"[?&]{k}=([^&#]+)", 1) for k in keys]
    complete = reduce(lambda a, b: a & b, (v != "" for v in values))
    path = F.regexp_extract(c, rf"^https://{host}(/s/[A-Za-z0-9_-]+)", 1)
    by_query = F.concat(F.lit(f"https://{host}/s?"), F.concat_ws("&", *[F.concat(F.lit(f"{k}="), v) for k, v in zip(keys, values, strict=True)]))
    return F.when(path != "", F.concat(F.lit(f"https://{host}"), path)).when(c.rlike(rf"^https://{host}/s\?") & complete, by_query)


def name_variants(c: Column, prefixes: list[str], suffixes: list[str], joiner: str = "暨", least: int = 6) -> Column:
    """Keywords for a name: itself, its parts around a joining word, and each without a usual beginning or end; those of
    `least` characters or more, each once."""
    whole = title_match_key(c)
    parts = F.array_distinct(F.concat(F.array(whole), F.split(whole, joiner)))
    cut = lambda p: F.array_compact(
        F.array(p, *[F.when(F.startswith(p, F.lit(x)), F.substring(p, F.lit(len(x) + 1), F.length(p))) for x in prefixes], *[F.when(F.endswith(p, F.lit(x)), F.substring(p, F.lit(1), F.length(p) - len(x))) for x in suffixes])
    )
    return F.filter(F.array_distinct(F.flatten(F.transform(parts, cut))), lambda k: F.length(k) >= least)


def first_contact(c: Column) -> Column:
    """struct<name, phone, email, qq>: the first of each that a text gives, empty where it gives none."""
    name = F.regexp_extract(c, r"(?:联系人|联络人|负责人)[：: \t]*([^，,。；;：:（(、\d\s]{2,25})", 1)
    first = lambda a: F.coalesce(F.get(a, 0), F.lit(""))
    return F.struct(name.alias("name"), first(phones(c)).alias("phone"), first(emails(c)).alias("email"), F.regexp_extract(c, r"(?i)QQ[群号：: \t]*([0-9]{5,12})", 1).alias("qq"))


def subdomains(c: Column, domain: str, noise: list[str]) -> Column:
    """Subdomain tokens that a line of scanned text may hold: the line itself if it is one, and what stands before the
    domain; lower case, each once, noise and numbers left out."""
    line = F.trim(c)
    alone = F.when(line.rlike(r"^[a-z][a-z0-9]{1,14}$"), F.array(line)).otherwise(F.array().cast("array<string>"))
    before = F.transform(F.regexp_extract_all(c, F.lit(rf"(?i)([a-z0-9-]{{2,20}})\s*[·/.]\s*{domain}"), 1), lambda x: F.lower(x))
    return F.filter(F.array_distinct(F.concat(alone, before)), lambda x: ~x.isin(*noise) & ~x.rlike("^[0-9]+$"))


def competition_names(title: Column) -> Column:
    """Names of contests that a title gives, as it gives them, each once."""
    found = F.regexp_extract_all(title, F.lit(r"((?:第[一二三四五六七八九十百零〇\d]+届)?[^，。；：“”\n]{2,80}(?:竞赛|大赛|挑战赛|世界杯))"), 1)
    return F.array_distinct(F.transform(found, lambda x: F.trim(F.regexp_replace(x, r"^(?:关于|组织|举办|开展|参加)+", ""))))


def track_names(title: Column) -> Column:
    """Names of tracks of a contest that a title gives, each once."""
    patterns = (r"([A-Za-z][A-Za-z0-9]*[一-鿿]{0,12}赛道)", r"[“「《]([^“”「」《》，。；]{1,35}赛道)[”」》]", r"[（(]([^）)，。；]{1,35}赛道)[）)]", r"(?:竞赛|大赛)([^，。；\s—–：:（(“”「」《》]{2,30}(?:赛道|专题赛))", r"(?:—|–|：|:)([^，。；：:]{1,25}赛道)")
    return F.array_distinct(F.transform(F.flatten(F.array(*[F.regexp_extract_all(title, F.lit(p), 1) for p in patterns])), lambda x: F.trim(x)))


def track_id(name: Column) -> Column:
    return F.concat(F.lit("track-"), F.substring(F.sha2(name.cast("binary"), 256), 1, 10))


def noise_line(c: Column, exact: list[str], words: list[str]) -> Column:
    """Headers, footers and page numbers of a laid-out table."""
    compact = F.regexp_replace(c, r"[ 　]", "")
    return contains_any(c, words) | compact.isin(*exact) | compact.rlike(r"^[-\s]*[0-9]+[-\s]*$")
