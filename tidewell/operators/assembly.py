"""Programs that put tables together: notices with their bodies, the master table, the link list, the coverage of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.functions import dates, text
from tidewell.operators import dictionary, merging


def body_columns(bodies: DataFrame, links: int = 4) -> DataFrame:
    """url, fetch_status, fetch_error, fetched_at, excerpt, links (array of url, text, kind) of bodies (url, status,
    error, fetched_at, body, attachments, form_links: arrays of struct url, text). What wasn't read has no content; an
    unknown status counts as failed. Forms stand before files, and only http(s) links count."""
    http = lambda a, kind: F.transform(F.filter(F.coalesce(a, F.array().cast("array<struct<url:string,text:string>>")), lambda x: x["url"].rlike("(?i)^https?://")), lambda x: F.struct(x["url"].alias("url"), F.substring(F.coalesce(x["text"], x["url"]), 1, 60).alias("text"), F.lit(kind).alias("kind")))
    ok = (F.coalesce("error", F.lit("")) == "") & (F.coalesce("status", F.lit("success")) == "success")
    status = F.when(ok, F.when(F.trim(F.coalesce("body", F.lit(""))) != "", "success").otherwise("empty")).when(F.col("status").isin("failed", "empty"), F.col("status")).otherwise("failed")
    kept = F.slice(F.concat(http(F.col("form_links"), "form"), http(F.col("attachments"), "file")), 1, links)
    return bodies.filter("url is not null").select("url", status.alias("fetch_status"), F.when(ok, "").otherwise(F.coalesce("error", F.lit(""))).alias("fetch_error"), "fetched_at", F.when(ok, text.head_excerpt(F.col("body"))).alias("excerpt"), F.when(ok, kept).alias("links"))


def with_bodies(notices: DataFrame, bodies: DataFrame) -> DataFrame:
    """notices with the columns of bodies by url: a body's value wins, a notice's own stays where there is none, and a
    notice without a body is pending."""
    theirs = [c for c in bodies.columns if c != "url"]
    joined = notices.join(bodies.select("url", *[F.col(c).alias(f"{c}__b") for c in theirs]), "url", "left")
    both = [F.coalesce(f"{c}__b", c).alias(c) if c in notices.columns else F.col(f"{c}__b").alias(c) for c in theirs]
    made = joined.select(*[c for c in notices.columns if c not in theirs], *both)
    return made.withColumn("fetch_status", F.coalesce("fetch_status", F.lit("pending"))) if "fetch_status" in made.columns else made


def current_facts(bodies: DataFrame, saved: DataFrame, fresh: DataFrame) -> DataFrame:
    """url, content_hash, facts, origin: saved facts of the same url and content hash, where they are valid; else those
    read now. saved: url, content_hash, facts, valid; fresh: url, facts."""
    joined = bodies.select("url", "content_hash").join(saved.filter("valid").select("url", "content_hash", F.col("facts").alias("old")), ["url", "content_hash"], "left").join(fresh.select("url", F.col("facts").alias("new")), "url", "left")
    return joined.select("url", "content_hash", F.coalesce("old", "new").alias("facts"), F.when(F.col("old").isNotNull(), "saved").when(F.col("new").isNotNull(), "rules").alias("origin"))


def with_resources(records: DataFrame, resources: DataFrame) -> DataFrame:
    """records (url, content_hash, attachments, images: arrays of asset urls) with the resources that each itself lists,
    sorted by id, and content_hash made over both where there are any; body_hash is that of the body alone. resources:
    id, notice_url, url, sha256, status, parser_version, text."""
    allowed = F.array_union(F.coalesce("attachments", F.array().cast("array<string>")), F.coalesce("images", F.array().cast("array<string>")))
    listed = records.select(F.col("url").alias("notice_url"), F.explode(allowed).alias("url"))
    own = resources.join(listed, ["notice_url", "url"], "left_semi")
    each = F.struct("id", "url", "sha256", "status", "parser_version", "text")
    made = own.groupBy("notice_url").agg(F.sort_array(F.collect_list(each)).alias("resources"))
    joined = records.join(made, records.url == made.notice_url, "left").drop("notice_url").withColumn("body_hash", F.col("content_hash"))
    hashed = F.sha2(F.to_json(F.struct(F.col("content_hash").alias("body"), F.col("resources"))), 256)
    return joined.withColumn("content_hash", F.when(F.col("resources").isNotNull(), hashed).otherwise(F.col("content_hash")))


def facts_not_yet(old: Column, new: Column, ignore: tuple[str, ...] = ("method", "verification", "flags"), members: tuple[str, ...] = ("value", "raw")) -> Column:
    """old and those of new (arrays of struct) that it has none like, but for how they were found."""
    sign = lambda x: F.struct(*[x[m] for m in members if m not in ignore])
    return F.concat(old, F.filter(new, lambda n: ~F.exists(old, lambda o: sign(o) == sign(n))))


def first_mapped(catalogue: DataFrame, listed: DataFrame, mapping: DataFrame) -> DataFrame:
    """catalogue (no, ..) with the columns of the listed row (list_key, ..) that a curated mapping (list_key, no, rank)
    ties to it, the first by rank where several do; and used rows are told by `unused`."""
    first = mapping.filter("no is not null").groupBy("no").agg(F.min(F.struct("rank", "list_key")).getField("list_key").alias("list_key"))
    return catalogue.join(first, "no", "left").join(listed, "list_key", "left")


def unused(listed: DataFrame, mapped: DataFrame) -> DataFrame:
    return listed.join(mapped.select("list_key").filter("list_key is not null"), "list_key", "left_anti")


def match_names(rows: DataFrame, names: DataFrame, least: int = 6, gram: int = 6) -> DataFrame:
    """name_id, row_id: for each name (name_id, name, no) the first row (row_id, name, no) that has its number, else the
    first whose normalised name is equal or holds it or is held by it, both of `least` characters or more.

    Equal numbers and equal normalised names are one each before anything is joined, the first of their rows standing
    for all. Names that contain one another share their runs of `gram` characters, so candidates come from an equi-join
    on the first run of the shorter one among all runs of the longer; nothing is compared with everything.
    """
    names = names.select("name_id", F.col("no").alias("want"), text.normal_name(F.col("name")).alias("n"))
    first = F.min("row_id").alias("row_id")
    numbered = names.join(rows.groupBy(F.col("no").alias("want")).agg(first), "want").groupBy("name_id").agg(first)
    runs = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - gram + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(gram))))
    head = lambda c: F.substring(c, 1, gram)
    rest = names.join(numbered, "name_id", "left_anti")
    called, wanted = rows.groupBy("name").agg(first).groupBy(text.normal_name(F.col("name")).alias("r")).agg(first), rest.select("n").distinct()
    long_rows, long_names = called.filter(F.length("r") >= least), wanted.filter(F.length("n") >= least)
    equal = wanted.join(called, F.col("n") == F.col("r")).select("n", "row_id")
    held = long_names.withColumn("g", F.explode(runs(F.col("n")))).join(long_rows.withColumn("g", head(F.col("r"))), "g").filter(F.contains("n", "r")).select("n", "row_id")
    holds = long_names.withColumn("g", head(F.col("n"))).join(long_rows.withColumn("g", F.explode(runs(F.col("r")))), "g").filter(F.contains("r", "n")).select("n", "row_id")
    named = rest.join(equal.unionByName(held).unionByName(holds).groupBy("n").agg(first), "n").groupBy("name_id").agg(first)
    return numbered.unionByName(named)


def merge_list(rows: DataFrame, names: DataFrame, category: str, source: str, unknown: str, most: str = "category") -> DataFrame:
    """rows (row_id, name, no, category, contact, source, reason) with a further list (name_id, name, no, contact, note)
    laid over: a matched row takes the contact of the last name that matched it, the list's category only if it has none
    yet, adds the source and the notes in order; what matches nothing is appended."""
    matched = match_names(rows, names)
    over = matched.join(names.select("name_id", F.col("contact").alias("new_contact"), F.nullif("note", F.lit("")).alias("note")), "name_id")
    over = over.groupBy("row_id").agg(F.max_by("new_contact", "name_id").alias("new_contact"), F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("note").isNotNull(), F.struct("name_id", "note")))), lambda x: x["note"]), "；").alias("notes"))
    joined = rows.join(over.withColumn("hit", F.lit(True)), "row_id", "left")
    made = joined.select(
        "row_id", "name", "no", F.when(F.col("hit") & (F.col(most) == unknown), category).otherwise(F.col(most)).alias("category"), F.when(F.col("hit"), F.coalesce("new_contact", F.lit(""))).otherwise(F.col("contact")).alias("contact"),
        F.when(F.col("hit") & ~F.contains("source", F.lit(source)), F.concat("source", F.lit("+" + source))).otherwise(F.col("source")).alias("source"),
        F.when(F.coalesce("notes", F.lit("")) != "", F.regexp_replace(F.concat_ws("；", "reason", "notes"), "^；+|；+$", "")).otherwise(F.col("reason")).alias("reason"),
    )
    none = F.lit(None)
    fresh = names.join(matched, "name_id", "left_anti").select(none.cast("long").alias("row_id"), "name", none.cast("int").alias("no"), F.lit(category).alias("category"), F.coalesce("contact", F.lit("")).alias("contact"), F.lit(source).alias("source"), F.coalesce("note", F.lit("")).alias("reason"))
    return made.unionByName(fresh)


def master_order(score: str = "score", number: str = "no", name: str = "name") -> list[Column]:
    """Score from high to low (none last), then number (none last), then name by code point."""
    return [F.desc(F.coalesce(F.col(score), F.lit(-1))), F.coalesce(F.col(number), F.lit(999)), F.col(name)]


def clean_category(c: Column, other: str, fixes: dict[str, str] | None = None) -> Column:
    """Without white space and what isn't a letter in front; by the table of fixes; `other` if nothing is left."""
    plain = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", ""), r"^[^\p{IsHan}A-Za-z]+", "")
    for wrong, right in (fixes or {}).items():
        plain = F.when(plain == wrong, right).otherwise(plain)
    return F.when(plain == "", other).otherwise(plain)


def merge_links(parts: list[DataFrame], renames: dict[str, str], overrides: DataFrame, other: str, presets: list[str], last: str) -> tuple[DataFrame, DataFrame]:
    """(links, categories): lists of links (seq, name, url, category) in order of priority, one of each URL but for
    scheme, www. and slashes; categories cleaned, renamed, then overridden by URL like names (overrides: url, category,
    name); a name that is taken gets the first part of its host. categories (position, category): the presets that
    occur, then the others sorted, then `last`."""
    tagged = [p.withColumn("key", text.url_key(F.col("url"))).withColumn("part", F.lit(i)) for i, p in enumerate(parts)]
    union = tagged[0]
    for p in tagged[1:]:
        union = union.unionByName(p)
    once = merging.first_by(union.filter("key <> ''"), [F.col("key")], [F.col("part"), F.col("seq")])
    category = clean_category(F.col("category"), other)
    for old, new in renames.items():
        category = F.when(category == old, new).otherwise(category)
    fixes = overrides.select(text.url_key(F.col("url")).alias("key"), F.col("category").alias("category__f"), F.col("name").alias("name__f"))
    joined = once.withColumn("category", category).join(fixes, "key", "left")
    fixed = joined.withColumn("category", F.coalesce("category__f", "category")).withColumn("name", F.coalesce("name__f", "name")).drop("category__f", "name__f")
    host = F.regexp_extract("key", r"^([^./]*)", 1)
    links = merging.disambiguate(fixed, "name", host, [F.col("part"), F.col("seq")])
    position = F.coalesce(*[F.when(F.col("category") == renames.get(c, c), F.lit(i)) for i, c in enumerate(presets) if c != last], F.when(F.col("category") == last, F.lit(1 << 30)), F.lit(1 << 20))
    return links, links.select("category").distinct().withColumn("position", position)


def source_coverage(competitions: DataFrame, rules: DataFrame, status: DataFrame) -> DataFrame:
    """competition, sources (array of key, last_run): the sources of all rules (rank, keyword, exact, keys) whose keyword
    the name holds (or is, where exact), each once, in the order of the rules, with the last run of each source. An empty
    keyword matches nothing."""
    names = competitions.select("competition").filter("competition is not null").distinct()
    same = names.join(rules.filter("exact"), F.col("competition") == F.col("keyword")).select("competition", "rank", "keys")
    within = dictionary.occurrences(names, "competition", "competition", rules.filter("not exact"), "keyword")
    held = within.join(rules.filter("not exact"), F.col("name") == F.col("keyword")).select(F.col("key").alias("competition"), "rank", "keys")
    found = same.unionByName(held).select("competition", "rank", F.posexplode("keys").alias("pos", "key"))
    first = found.groupBy("competition", "key").agg(F.min(F.struct("rank", "pos")).alias("at"))
    joined = first.join(status.select("key", "last_run"), "key", "left")
    return joined.groupBy("competition").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "key", "last_run"))), lambda x: F.struct(x["key"].alias("key"), x["last_run"].alias("last_run"))).alias("sources"))


def deadline_table(old: DataFrame, bodies: DataFrame, safe: DataFrame) -> DataFrame:
    """url, deadline, score, legacy, verification over all urls of an earlier table (url, deadline, legacy) and of the
    bodies (url, status). Only what the text of a body says counts; a date that has lost its text is kept apart."""
    joined = old.select("url", F.nullif("deadline", F.lit("")).alias("was"), F.nullif("legacy", F.lit("")).alias("kept")).join(bodies.select("url", F.col("status").alias("body_status")), "url", "full_outer").join(safe.select("url", "safe"), "url", "left")
    read = F.coalesce(F.col("body_status") == "success", F.lit(False))
    legacy = F.when(F.col("body_status").isNull(), F.coalesce("was", "kept"))
    deadline = F.when(read, F.col("safe"))
    return joined.select("url", deadline.alias("deadline"), F.when(deadline.isNotNull(), 4).otherwise(0).alias("score"), legacy.alias("legacy"), F.when(legacy.isNotNull(), "needs_review").alias("verification"))


def recruiting(competitions: DataFrame, registration: DataFrame, notices: DataFrame, today: Column, days: int = 120) -> DataFrame:
    """competition, notices, campus_notices, latest (url), open_deadline, is_open, is_selecting, select_notice,
    is_recruiting. registration: competition, status, next_deadline, open_urls (array). notices: url, title, date,
    competition, is_campus. Selecting: a campus notice of the last days that an open date stands in."""
    seen = notices.groupBy("competition").agg(F.count("*").alias("notices"), F.count_if("is_campus").alias("campus_notices"), F.max_by("url", F.struct("date", "url")).alias("latest"))
    age = dates.days_since(F.col("date"), today)
    opened = registration.filter("status = 'open'").select("competition", F.explode("open_urls").alias("url"))
    selecting = notices.filter(F.col("is_campus") & age.between(0, days)).join(opened, ["competition", "url"], "left_semi").groupBy("competition").agg(F.max_by("url", F.struct("date", "url")).alias("select_notice"))
    joined = competitions.join(seen, "competition", "left").join(registration, "competition", "left").join(selecting, "competition", "left")
    is_open = F.coalesce(F.col("status") == "open", F.lit(False))
    return joined.select(
        "competition", F.coalesce("notices", F.lit(0)).alias("notices"), F.coalesce("campus_notices", F.lit(0)).alias("campus_notices"), "latest", F.coalesce(F.when(is_open, F.col("next_deadline")), F.lit("")).alias("open_deadline"),
        is_open.alias("is_open"), F.col("select_notice").isNotNull().alias("is_selecting"), "select_notice", (is_open | F.col("select_notice").isNotNull()).alias("is_recruiting"),
    )


def last_success(attempts: DataFrame, key: str = "url") -> DataFrame:
    """The newest row of each key (attempts: key, at, status, ..), with last_success: the newest row that was one."""
    rest = [c for c in attempts.columns if c != key]
    row = F.struct(*rest)
    made = attempts.groupBy(key).agg(F.max_by(row, F.struct("at", "status")).alias("now"), F.max_by(F.when(F.col("status") == "success", row), F.when(F.col("status") == "success", F.col("at"))).alias("last_success"))
    return made.select(key, *[F.col(f"now.{c}").alias(c) for c in rest], "last_success")


def reusable(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """requests (id, sha256, parser_version, parser_config) with `reuse`: whether the cache has a successful result of the
    same blob, parser version and configuration. Only the keys travel."""
    keys = ["sha256", "parser_version", "parser_config"]
    done = cache.filter("status = 'success'").select(*keys).distinct().withColumn("reuse", F.lit(True))
    return requests.join(done, keys, "left").withColumn("reuse", F.coalesce("reuse", F.lit(False)))


def aliases(catalogue: DataFrame, curated: DataFrame) -> DataFrame:
    """name, aliases: its name, the name it has in other lists, and curated ones (name, alias, rank), each once in order."""
    more = curated.groupBy("name").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "alias"))), lambda x: x["alias"]).alias("more"))
    all_names = F.concat(F.array("name", "alias"), F.coalesce("more", F.array().cast("array<string>")))
    return catalogue.select("name", F.nullif("alias", F.lit("")).alias("alias")).join(more, "name", "left").select("name", F.array_distinct(F.array_compact(all_names)).alias("aliases"))


def rank_rows(df: DataFrame, key: str, order: list[Column], most: int) -> DataFrame:
    """The first `most` rows of each key, numbered by `turn`."""
    return df.withColumn("turn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("turn") <= most)
