"""Fields of notices as one table of facts: names, editions, tracks, audiences, ways to register, materials, contacts,
groups and links, each with the text that it was read from.

A fact is a row (url, field, item, value, raw, type, at, start, end, method, flags, verification, track). `raw` is what
stands at start to end of the place (title, body, link, image or chunk); a fact with flags needs review. Facts of one
person or group share `item`. Sentences are rows; what a sentence takes from earlier ones of its notice (the section it
is in, the track that is spoken of, the person named last) comes by windows over the sentences of that notice.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.functions import facts, text
from tidewell.operators import rounds

#: Sentences, headings, sections and what tells each field.
SENTENCE = r"[^\n。；;]+[。；;]?"
HEADING = r"^(?:[一二三四五六七八九十\d]+[、.．]|[（(][一二三四五六七八九十]+[）)])\s*[^，。；：:]{2,22}[：:]?$"
TRACK_HEADER = r"^(?:[一二三四五六七八九十\d]+[、.．)]\s*)?([^，。；：:]{1,35}(?:赛道|组别|赛项))[：:]?$"
COMMON_PART = r"^(?:[一二三四五六七八九十]+[、.．])?(?:共同|通用|其他事项|注意事项|附件)"
SECTIONS = {"audiences": r"参赛对象|报名对象|参赛资格|参赛条件|参赛主体", "registrationMethods": r"报名方式|报名方法|报名流程|报名与.*流程", "registration": r"报名|注册|登记"}
FIELDS = {
    "audiences": r"参赛对象|报名对象|参赛主体|面向.*(?:学生|本科|研究生)|(?:本科生|本科学生|研究生|少年班|大一|大二|大三).*可.*(?:报名|参赛)",
    "registrationMethods": r"报名方式|报名方法|通过.*报名|填写.*报名|报名.*(?:网站|平台|邮件|提交)|扫描.*报名|扫码报名",
    "requiredMaterials": r"(?i)(?:材料|提交|报送|上传|递交).*(?:报名表|申请表|作品|论文|PPT|身份证|证明|承诺书|材料)",
}
EDITION = r"第[一二三四五六七八九十百零〇\d]+届"
NAMED = r"(?:联系人|联络人|负责人)[：: \t]+([^，,。；;：:（(、\d\s]{2,25})"
TEACHER = r"(?:^|[，,；;：: \t])([一-鿿]{1,4}老师)(?=[，,。；;：:(（ \t\d]|电话|手机|邮箱|$)"
BEFORE_PHONE = r"(?:^|[，,；; \t])((?!电话|手机|联系)[一-鿿]{2,4})(?=[：: \t]*(?:电话[：: \t]*)?(?:1\d{10}|0\d{2,3}[- ]?\d{7,8}))"
JOINT = r"(?:联系人|联络人)[：: \t]*([一-鿿]{2,6})[、和及与]([一-鿿]{2,6})(?=[，,：: \t]|$)"
NO_NAMES = ["联系方式", "邮箱", "电话", "报名", "竞赛"]
CONTACT_LINE = r"(?i)^(?:联系)?(?:电话|手机|邮箱|电子邮箱|E-mail|Email|QQ)[：: \t]"
GROUP = r"(?i)QQ\s*(?:交流|联络|咨询|报名|竞赛)?群|(?:交流|联络|竞赛)QQ群|群号"
URL = r"(https?://[^\s，。；;）)<>]+|www\.[a-zA-Z0-9.-]+(?:/[^\s，。；;）)<>]*)?)"
ENTRY_LINK = r"(?i)报名|登记|注册|填.*信息|form|signup|register|enroll"
GROUP_IMAGE = r"(?i)(?:交流|联络|竞赛|QQ|微信).*群|群.*二维码"
COLUMNS = ("url", "field", "item", "value", "raw", "type", "at", "start", "end", "method", "flags", "verification", "track")


def no_flags() -> Column:
    return F.array().cast("array<string>")


def fact(df: DataFrame, field: str, value: Column, item: Column | None = None, flags: Column | None = None, kind: str = "body", at: Column | None = None, track: Column | None = None) -> DataFrame:
    """Facts of rows with url, raw, start, end and track."""
    flags = no_flags() if flags is None else flags
    none = F.lit(None)
    own = {
        "field": F.lit(field), "item": none.cast("string") if item is None else item, "value": value, "type": F.lit(kind), "at": none.cast("string") if at is None else at, "method": F.lit("rule"), "flags": flags,
        "verification": F.when(F.size(flags) > 0, "needs_review").otherwise("source_matched"), "track": F.col("track") if track is None else track,
    }
    return df.select(*[own.get(c, F.col(c)).alias(c) for c in COLUMNS])


def sentences(docs: DataFrame) -> DataFrame:
    """url, no, raw, start, end, heading, track, in_audiences, in_methods, in_registration, in_groups, contact_run of docs
    (url, title, body): their sentences, trimmed, with the sections that they are in.

    A heading opens sections and ends the track that was spoken of; a header of a track opens that; a part for all ends
    it. If the title names exactly one track, that holds where no other does. contact_run numbers the runs of sentences
    that speak of contacts."""
    found = docs.withColumn("own_track", F.when(F.size(text.track_names(F.coalesce("title", F.lit("")))) == 1, text.track_id(text.track_names(F.col("title"))[0])))
    found = found.withColumn("all__", facts.spans(F.col("body"), SENTENCE, r"\Z")).select("url", "own_track", F.posexplode("all__").alias("no", "m"))
    lead = F.length("m.raw") - F.length(F.regexp_replace("m.raw", r"^[\s　]+", ""))
    made = found.select("url", "own_track", "no", F.regexp_replace("m.raw", r"^[\s　]+|[\s　]+$", "").alias("raw"), (F.col("m.start") + lead).alias("start")).filter("raw <> ''").withColumn("end", F.col("start") + F.length("raw"))
    raw = F.col("raw")
    heading, header, common = raw.rlike(HEADING), raw.rlike(TRACK_HEADER) & ~raw.rlike(r"^(?:[一二三四五六七八九十\d]+[、.．)]\s*)?(?:各|所有|多个|比赛)"), raw.rlike(COMMON_PART)
    so_far = Window.partitionBy("url").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    carried = lambda change: F.last(change, ignorenulls=True).over(so_far)
    section = lambda pattern: F.coalesce(carried(F.when(heading, raw.rlike(pattern))), F.lit(False))
    change = F.when(header, F.struct(text.track_id(F.regexp_extract(raw, TRACK_HEADER, 1)).alias("t"))).when(common, F.struct(F.lit(None).cast("string").alias("t"))).when(heading, F.struct(F.col("own_track").alias("t")))
    groups = F.when(raw.rlike(r"(?i)QQ群") & ~raw.rlike(r"\d{5,}"), True).when(heading | (raw.rlike(r"^[【\[].+[】\]]$") & ~raw.rlike(r"(?i)QQ群")), False)
    contact = raw.rlike(r"群|电话|邮箱|联系人|联络人|负责人|老师") | raw.rlike(CONTACT_LINE) | (F.size(text.phones(raw)) > 0) | (F.size(text.emails(raw)) > 0)
    active = carried(change)
    return made.select(
        "url", "no", "raw", "start", "end", heading.alias("heading"), F.when(active.isNull(), F.col("own_track")).otherwise(active["t"]).alias("track"), section(SECTIONS["audiences"]).alias("in_audiences"), section(SECTIONS["registrationMethods"]).alias("in_methods"),
        section(SECTIONS["registration"]).alias("in_registration"), F.coalesce(carried(groups), F.lit(False)).alias("in_groups"), F.sum(F.when(contact & ~heading, 0).otherwise(1)).over(so_far).alias("contact_run"), header.alias("header"),
    )


Entry = Column  # array<struct<field, item, value, flags, track>>: facts that a row gives


def entry(field: str, values: Column, item: Callable[[Column], Column] | Column | None = None, flags: Column | None = None, track: Callable[[Column], Column] | None = None, when: Column | None = None) -> Entry:
    """A fact for each of the values (array), if `when` holds; item and track may hang on the value."""

    def one(v: Column) -> Column:
        own = F.lit(None).cast("string") if item is None else item(v) if callable(item) else item
        return F.struct(F.lit(field).alias("field"), own.alias("item"), v.alias("value"), (no_flags() if flags is None else flags).alias("flags"), (F.col("track") if track is None else track(v)).alias("track"))

    made = F.transform(values, one)
    none = F.array().cast("array<struct<field:string,item:string,value:string,flags:array<string>,track:string>>")
    return F.coalesce(made if when is None else F.when(when, made), none)


def stated(df: DataFrame, entries: list[Entry], kind: str = "body") -> DataFrame:
    """The facts of rows with url, raw, start and end: one pass over them, whatever the number of fields."""
    found = df.select("url", "raw", "start", "end", F.explode(F.concat(*entries)).alias("f"))
    own = {"type": F.lit(kind), "at": F.lit(None).cast("string"), "method": F.lit("rule"), "verification": F.when(F.size("f.flags") > 0, "needs_review").otherwise("source_matched")}
    own |= {c: F.col(f"f.{c}") for c in ("field", "item", "value", "flags", "track")}
    return found.select(*[own.get(c, F.col(c)).alias(c) for c in COLUMNS])


def title_facts(docs: DataFrame) -> DataFrame:
    """Names, editions and tracks that the titles give."""
    base = docs.filter("coalesce(title, '') <> ''").select("url", F.col("title").alias("raw"), F.lit(0).alias("start"), F.length("title").alias("end"), F.lit(None).cast("string").alias("track"))
    entries = [entry("competitionNames", text.competition_names(F.col("raw"))), entry("editions", F.array_distinct(F.regexp_extract_all("raw", F.lit(EDITION), 0))), entry("tracks", text.track_names(F.col("raw")), track=text.track_id)]
    return stated(base, entries, "title")


def sentence_entries() -> list[Entry]:
    raw, plain = F.col("raw"), ~F.col("heading")
    out = [entry("editions", F.array_distinct(F.regexp_extract_all("raw", F.lit(EDITION), 0))), entry("tracks", F.array(F.regexp_extract(raw, TRACK_HEADER, 1)), when=F.col("header"))]
    wanted = {"audiences": plain & (F.col("in_audiences") | raw.rlike(FIELDS["audiences"])), "registrationMethods": plain & (F.col("in_methods") | raw.rlike(FIELDS["registrationMethods"])), "requiredMaterials": raw.rlike(FIELDS["requiredMaterials"])}
    return out + [entry(field, F.array(raw), when=condition) for field, condition in wanted.items()]


def sentence_facts(said: DataFrame) -> DataFrame:
    """Editions, tracks, audiences, ways to register and materials that the sentences give."""
    return stated(said, sentence_entries())


def with_people(said: DataFrame) -> DataFrame:
    """said with joint (two names that share what follows), people (array of item, name, part: what stands between a name
    and the next), person (the last of them) and to (the person named last in the same run of sentences, or nobody)."""
    raw = F.col("raw")
    loose = (F.size(text.phones(raw)) > 0) | (F.size(text.emails(raw)) > 0) | raw.rlike(r"^[一-鿿]{1,4}老师$")
    marked = said.withColumn("joint", raw.rlike(JOINT))
    named = marked.withColumn("some__", facts.spans(F.when(~F.col("joint"), raw), NAMED, r"\Z")).withColumn("more__", facts.spans(F.when(~F.col("joint") & loose, raw), f"{TEACHER}|{BEFORE_PHONE}", r"\Z"))
    apart = F.filter("more__", lambda m: ~F.exists("some__", lambda s: (m["start"] < s["start"] + F.length(s["raw"])) & (s["start"] < m["start"] + F.length(m["raw"]))))
    found = F.array_sort(F.transform(F.concat("some__", apart), lambda m: F.struct(m["start"].alias("s"), F.coalesce(m["groups"][0], F.try_element_at(m["groups"], F.lit(2))).alias("name"))))

    def person(f: Column, k: Column) -> Column:
        stop = F.coalesce(F.get("found__", k + 1)["s"], F.length("raw"))
        name = F.element_at(F.split(f["name"], r"学院|学部|中心|办公室"), -1)
        return F.struct(F.concat_ws(":", "url", "no", k.cast("string")).alias("item"), name.alias("name"), F.substring(F.col("raw"), f["s"] + 1, stop - f["s"]).alias("part"))

    named = named.withColumn("found__", F.coalesce(found, F.array().cast("array<struct<s:int,name:string>>"))).drop("some__", "more__")
    named = named.withColumn("people", F.filter(F.transform("found__", person), lambda p: (p["name"] != "") & ~p["name"].isin(*NO_NAMES))).drop("found__")
    named = named.withColumn("person", F.try_element_at("people", F.lit(-1))["item"])
    before = Window.partitionBy("url", "contact_run", "track").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    return named.withColumn("to", F.coalesce(F.last("person", ignorenulls=True).over(before), F.concat_ws(":", "url", "contact_run", F.coalesce("track", F.lit("-")), F.lit("nobody"))))


def contact_entries() -> list[Entry]:
    raw, joint, kinds = F.col("raw"), F.col("joint"), (("phones", text.phones), ("emails", text.emails))
    shared, unsure = F.concat_ws(":", "url", "no", F.lit("shared")), F.array(F.lit("relationship_ambiguous"))
    out = [entry("contacts.name", F.array(F.regexp_extract(raw, JOINT, 1), F.regexp_extract(raw, JOINT, 2)), lambda v: F.concat_ws(":", "url", "no", v), when=joint)]
    out += [entry(f"contacts.{kind}", values(raw), shared, unsure, when=joint) for kind, values in kinds]

    def of_people(field: str, values: Callable[[Column], Column]) -> Entry:
        one = lambda p: F.transform(values(p), lambda v: F.struct(F.lit(field).alias("field"), p["item"].alias("item"), v.alias("value"), no_flags().alias("flags"), F.col("track").alias("track")))
        return F.flatten(F.transform("people", one))

    out += [of_people("contacts.name", lambda p: F.array(p["name"]))] + [of_people(f"contacts.{kind}", lambda p, values=values: values(p["part"])) for kind, values in kinds]
    alone = ~joint & F.col("person").isNull() & raw.rlike(CONTACT_LINE)
    out += [entry(f"contacts.{kind}", values(raw), F.col("to"), when=alone) for kind, values in kinds]
    qq = F.regexp_extract(raw, r"(?i)QQ[号：: \t]*(\d{5,12})", 1)
    return [*out, entry("contacts.qq", F.array(qq), F.coalesce("person", "to"), when=~joint & ~raw.rlike(GROUP) & ~(F.col("in_groups") & raw.rlike("群[：:]")) & (qq != ""))]


def contact_facts(said: DataFrame) -> DataFrame:
    """Facts of persons (fields contacts.name, .phones, .emails, .qq), by item: what stands between a name and the next
    belongs to it; lines that only give numbers belong to the person named last in the same run of sentences. Numbers
    next to two names that share them belong to neither, and need review."""
    return stated(with_people(said), contact_entries())


def group_entries() -> list[Entry]:
    raw = F.col("raw")
    about = raw.rlike(GROUP) | (F.col("in_groups") & raw.rlike("群[：:]"))
    tail = F.element_at(F.split(F.when(raw.rlike(GROUP), F.regexp_extract(raw, f"(?s)(?:{GROUP})(.*)$".replace("(?i)", ""), 1)).otherwise(raw), "电话|手机|邮箱|联系人"), 1)
    numbers = F.regexp_extract_all(F.when(raw.rlike(r"群"), tail).otherwise(raw), F.lit(r"(?<!\d)\d{5,12}(?!\d)"), 0)
    kind = F.col("in_groups") | raw.rlike("(?i)QQ")
    item = lambda v: F.concat_ws(":", "url", v)
    return [entry("groups.qq", numbers, item, when=about & kind), entry("groups.unknown", numbers, item, when=about & ~kind)]


def group_facts(said: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """Numbers of groups (fields groups.qq, groups.unknown) and images that show how to join one (groups.image; images:
    url, image, context), which always need review."""
    numbers = stated(said, group_entries())
    return numbers if images is None else numbers.unionByName(image_facts(said, images))


def image_facts(said: DataFrame, images: DataFrame) -> DataFrame:
    of = images.filter(F.coalesce("context", F.lit("")).rlike(GROUP_IMAGE))
    scopes = said.groupBy("url", F.col("raw").alias("context")).agg(F.collect_set(F.coalesce("track", F.lit(""))).alias("tracks"))
    placed = of.join(scopes, ["url", "context"], "left").withColumn("track", F.when(F.size("tracks") == 1, F.nullif(F.col("tracks")[0], F.lit(""))))
    flags = F.array_compact(F.array(F.lit("image_requires_review"), F.when(F.size("tracks") > 1, "scope_ambiguous")))
    none = F.lit(None).cast("int")
    shown = placed.select("url", F.col("context").alias("raw"), none.alias("start"), none.alias("end"), "track", "image", flags.alias("f"))
    return fact(shown, "groups.image", F.col("image"), F.concat_ws(":", "url", "image"), F.col("f"), "image", F.col("image"))


def link_facts(said: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Links to register: typed ones and anchors (links: url, link, text) whose own words, sentence or address tell so. A
    bare address also takes the words of the sentence before it. One that stands in sentences of several tracks needs
    review, and a homepage isn't an entry by itself."""
    order = Window.partitionBy("url").orderBy("no")
    around = said.withColumn("previous", F.lag("raw").over(order))
    typed = around.withColumn("link", F.explode(F.array_distinct(F.regexp_extract_all("raw", F.lit(URL), 1))))
    first = typed.groupBy("url", "link").agg(F.min(F.struct("no", "raw", "start", "end", "track", "previous")).alias("c"), F.count_distinct(F.coalesce("track", F.lit(""))).alias("scopes"))
    rows = first.select("url", "link", "scopes", "c.raw", "c.start", "c.end", "c.track", F.when(F.regexp_replace("c.raw", "。+$", "") == F.col("link"), F.concat_ws(" ", "c.raw", "c.previous")).otherwise(F.col("c.raw")).alias("near"), F.lit("body").alias("kind"))
    if links is not None:
        other = links.join(first.select("url", "link"), ["url", "link"], "left_anti").dropDuplicates(["url", "link"])
        label = F.coalesce("text", F.lit(""))
        within = other.join(around.select("url", "no", F.col("raw").alias("s"), F.col("start").alias("s_start"), F.col("end").alias("s_end")), "url").filter((label != "") & F.contains("s", label)).groupBy("url", "link").agg(F.min(F.struct("no", "s", "s_start", "s_end")).alias("c"))
        placed = other.join(within, ["url", "link"], "left")
        none = F.lit(None).cast("string")
        rows = rows.unionByName(placed.select("url", "link", F.lit(1).cast("long").alias("scopes"), F.coalesce("c.s", F.nullif(label, F.lit("")), "link").alias("raw"), F.col("c.s_start").alias("start"), F.col("c.s_end").alias("end"), none.alias("track"), F.coalesce("c.s", label).alias("near"), F.when(F.col("c").isNull(), "link").otherwise("body").alias("kind")))
    full = F.when(F.col("link").rlike("^https?://"), F.col("link")).otherwise(F.concat(F.lit("https://"), "link"))
    kept = rows.filter(F.concat_ws(" ", "near", "link").rlike(ENTRY_LINK)).withColumn("full", full).filter(F.col("full").rlike(r"^https?://[^/]+"))
    flags = F.when(F.col("scopes") > 1, F.array(F.lit("scope_ambiguous"))).otherwise(no_flags())
    made = fact(kept, "registrationLinks", F.col("full"), flags=flags, at=F.col("link"), track=F.when(F.col("scopes") == 1, F.col("track")))
    return made.withColumn("type", F.when(F.col("start").isNull(), "link").otherwise("body"))


def extract(docs: DataFrame, links: DataFrame | None = None, images: DataFrame | None = None) -> DataFrame:
    """All facts of docs (url, title, body) but their dates, which notices.events gives. Null titles and bodies give none;
    rows that repeat a url count as one notice each only if their texts are the same. The sentences are worked out once,
    and kept in the shared folder, since links look at their neighbours again."""
    docs = docs.select("url", "title", "body").distinct()
    said, _ = rounds.kept(sentences(docs), "sentences")
    parts = [title_facts(docs), stated(with_people(said), sentence_entries() + contact_entries() + group_entries()), link_facts(said, links)]
    return reduce(DataFrame.unionByName, parts if images is None else [*parts, image_facts(said, images)])


def extract_resources(resources: DataFrame) -> DataFrame:
    """Facts of resources (url, resource, chunk, status, method, text), with `at` as "resource:chunk" and the method of
    the chunk. Only what was read at least in part, by a known method, counts; what was seen by OCR or in a QR code needs
    review, and an address in a QR code says nothing of its purpose."""
    usable = resources.filter(F.col("status").isin("success", "partial") & F.col("method").isin("attachment", "ocr", "qr") & (F.coalesce("text", F.lit("")) != ""))
    usable = usable.withColumn("place", F.concat_ws(":", "resource", "chunk"))
    found = extract(usable.select(F.col("place").alias("url"), F.lit(None).cast("string").alias("title"), F.col("text").alias("body")))
    address = usable.filter((F.col("method") == "qr") & F.col("text").rlike(r"^https?://\S+$")).select(F.col("place").alias("url"), F.col("text").alias("raw"), F.lit(0).alias("start"), F.length("text").alias("end"), F.lit(None).cast("string").alias("track"))
    found = found.filter(~((F.col("field") == "registrationLinks") & (F.col("raw") == F.col("value")))).unionByName(fact(address, "registrationLinks", F.col("raw"), flags=F.array(F.lit("qr_purpose_unverified"))))
    joined = found.drop("method", "at").withColumnRenamed("url", "place").join(usable.select("place", "url", "method"), "place")
    review = F.when(F.col("method").isin("ocr", "qr"), F.array_union("flags", F.array(F.concat("method", F.lit("_requires_review"))))).otherwise(F.col("flags"))
    made = joined.withColumn("flags", review).withColumns({"at": F.col("place"), "type": F.lit("resource"), "verification": F.when(F.size("flags") > 0, "needs_review").otherwise("source_matched")})
    return made.select(*COLUMNS)


def false_evidence(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Facts from titles and bodies whose raw text isn't what stands at their place."""
    there = F.when(F.col("type") == "title", F.col("title")).otherwise(F.col("body"))
    joined = found.filter("type in ('title', 'body')").join(docs.select("url", "title", "body"), "url")
    return joined.filter(~F.coalesce(F.substring(there, F.col("start") + 1, F.col("end") - F.col("start")) == F.col("raw"), F.lit(False))).select(*found.columns)


SAME = ("url", "field", "value", "raw", "type", "start", "end", "track")


def with_model(rules: DataFrame, claimed: DataFrame, docs: DataFrame) -> DataFrame:
    """The facts of the rules, and those that a model claims (the same columns) and the rules don't have, with model: the
    state of each notice (accepted, failed or none).

    All claims about a notice fall if one of them has evidence that isn't there or a value that its quote doesn't hold.
    A claim can't make itself sure: what the rules have in the same place keeps their judgement, all else needs review.
    """
    bad = false_evidence(claimed, docs).select("url").unionByName(claimed.filter(F.col("value").isNotNull() & ~F.contains("raw", "value")).join(rules.select(*SAME), list(SAME), "left_anti").select("url")).distinct()
    good = claimed.join(bad, "url", "left_anti")
    same = reduce(lambda a, b: a & b, (F.col(f"c.{c}").eqNullSafe(F.col(f"r.{c}")) for c in SAME if c != "url"))
    fresh = good.alias("c").join(rules.alias("r"), (F.col("c.url") == F.col("r.url")) & same, "left_anti")
    fresh = fresh.withColumns({"method": F.lit("model"), "flags": F.array_union("flags", F.array(F.lit("model_requires_review"))), "verification": F.lit("needs_review")})
    state = docs.select("url").distinct().join(claimed.select("url").distinct().withColumn("c", F.lit(True)), "url", "left").join(bad.withColumn("b", F.lit(True)), "url", "left").select("url", F.when(F.col("b"), "failed").when(F.col("c"), "accepted").otherwise("none").alias("model"))
    return rules.unionByName(fresh.select(*COLUMNS)).join(state, "url", "left")
