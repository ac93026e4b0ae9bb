"""Why a field of an edition is missing: not read, not parsed, not found, in doubt or in conflict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import facts
from tidewell.operators import reports

#: Labels in order; fields; gaps of reading; reasons by precedence; cues of unread resources and topics.
LABELS = ["no_notices", "no_current_notice", "identity_unknown", "identity_conflict", "body_pending", "fetch_failed", "body_empty", "fields_pending", "resource_pending", "resource_failed", "not_extracted", "needs_review", "conflict", "confirmed"]
FIELDS = ["deadline", "audiences", "registrationMethods", "registrationLinks", "requiredMaterials", "contacts", "groups"]
GAPS = ["fetch_failed", "body_pending", "body_empty", "fields_pending"]
FURTHER = ["conflict", "resource_failed", "resource_pending", "needs_review", "not_extracted"]
PRECEDENCE = ["conflict", "fetch_failed", "body_pending", "body_empty", "fields_pending", "resource_failed", "resource_pending", "needs_review", "not_extracted"]
CUE = (
    r"(?:见|查看|参见|参考|详见|下载).{0,20}(?:附件|附表)|(?:附件|附表).{0,20}(?:见|安排)|"
    r"(?:扫码|扫描|识别).{0,12}(?:报名|二维码|进群|加群)|报名二维码|群二维码|二维码.*(?:报名|进群)"
)
TOPICS = [
    (r"时间|日期|截止|安排", ["deadline"]), (r"报名|注册|登记", ["registrationMethods", "registrationLinks"]), (r"参赛对象|参赛资格|报名对象", ["audiences"]), (r"联系|咨询电话|电子邮箱", ["contacts"]),
    (r"进群|加群|交流群|QQ群|微信群|群二维码|群号", ["groups"]), (r"材料|报名表|申请表|承诺书", ["requiredMaterials"]),
]


def strings(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def first_in(found: Column, order: list[str], other: str) -> Column:
    """The first of `order` that the array holds."""
    return F.coalesce(*[F.when(F.array_contains(found, n), F.lit(n)) for n in order], F.lit(other))


def notice_state(status: Column, error: Column, has_fields: Column) -> Column:
    """How far a notice has been read, of body_empty, fetch_failed, confirmed, fields_pending, body_pending."""
    failed = (status == "failed") | (F.coalesce(error, F.lit("")) != "")
    return F.when(status == "empty", "body_empty").when(failed, "fetch_failed").when(has_fields, "confirmed").when(status == "success", "fields_pending").otherwise("body_pending")


def topics(c: Column) -> Column:
    """Fields that a text is about; all where it tells nothing."""
    found = F.array_distinct(F.flatten(F.array(*[F.when(c.rlike("(?i)" + pattern), strings(keys)).otherwise(F.array().cast("array<string>")) for pattern, keys in TOPICS])))
    return F.when(F.size(found) > 0, found).otherwise(strings(FIELDS))


def resource_hints(notices: DataFrame, assets: DataFrame, resources: DataFrame) -> DataFrame:
    """url, kind, asset, state, fields: what a notice leaves to its attachments and images, and to those it only mentions.

    notices: url, body. assets: url, kind (attachment or image), asset, text. resources: asset, status, chunks (number).
    A sentence that points to an asset holds the asset's own text; its topics count for the asset. What a notice points
    to without naming an asset is a hint of kind reference, whose topics count for all assets of the kind it means.
    """
    cue = F.filter(F.split(F.coalesce("body", F.lit("")), r"\n|(?<=[。；;])"), lambda s: s.rlike(CUE))
    cues = notices.select("url", F.transform(cue, lambda s: F.trim(s)).alias("cues"))
    state = F.when((F.col("status") == "success") & (F.col("chunks") > 0), "parsed").when(F.col("status") == "failed", "resource_failed").otherwise("resource_pending")
    one = assets.join(resources.select("asset", "status", "chunks"), "asset", "left").join(cues, "url").withColumn("state", state)
    pointing = F.get(F.filter("cues", lambda s: (F.coalesce("text", F.lit("")) != "") & F.contains(s, F.col("text"))), 0)
    one = one.withColumn("cue", pointing).withColumn("own", topics(F.coalesce("cue", "text", F.lit(""))))
    # A cue that no asset's text is part of is a hint of its own.
    named = one.groupBy("url").agg(F.collect_set("cue").alias("named"), F.collect_set(F.struct("kind", "state")).alias("of"))
    loose = cues.join(named, "url", "left").select("url", "of", F.explode(F.array_except("cues", F.coalesce("named", F.array().cast("array<string>")))).alias("cue"))
    loose = loose.withColumn("means", F.when(F.col("cue").rlike("附件|附表"), "attachment").otherwise("image")).withColumn("of", F.filter(F.coalesce("of", F.array().cast("array<struct<kind:string,state:string>>")), lambda o: o["kind"] == F.col("means")))
    loose_state = F.when((F.size("of") > 0) & F.forall("of", lambda o: o["state"] == "parsed"), "parsed").otherwise("resource_pending")
    more = loose.groupBy("url", F.col("means").alias("kind")).agg(F.array_distinct(F.flatten(F.collect_list(topics(F.col("cue"))))).alias("more"))
    direct = one.join(more, ["url", "kind"], "left").select("url", "kind", "asset", "state", F.array_union("own", F.coalesce("more", F.array().cast("array<string>"))).alias("fields"))
    return direct.unionByName(loose.select("url", F.lit("reference").alias("kind"), F.col("cue").alias("asset"), loose_state.alias("state"), topics(F.col("cue")).alias("fields")))


def edition_diagnosis(checks: DataFrame, hints: DataFrame, states: DataFrame) -> DataFrame:
    """edition_id, field_states (map), reasons (array), primary, partial, counts (map of notice states).

    checks: url, edition_id, state. hints: url, state, fields. states: edition_id, field, state with conflict,
    needs_review or confirmed for fields that something was found for; the rest is explained by what wasn't read.
    """
    unread = checks.join(hints.filter("state <> 'parsed'").select("url", F.col("state").alias("hint"), F.explode("fields").alias("field")), "url").groupBy("edition_id", "field").agg(F.max(F.when(F.col("hint") == "resource_failed", 2).otherwise(1)).alias("worst"))
    unread = unread.groupBy("edition_id").agg(F.map_from_entries(F.collect_list(F.struct("field", F.when(F.col("worst") == 2, "resource_failed").otherwise("resource_pending")))).alias("unread"))
    counts = checks.groupBy("edition_id", "state").agg(F.count("*").alias("n")).groupBy("edition_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("state", "n")))).alias("counts"))
    found = states.groupBy("edition_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "state"))).alias("found"))
    joined = counts.join(unread, "edition_id", "left").join(found, "edition_id", "left")
    gaps = F.filter(strings(GAPS), lambda g: F.array_contains(F.map_keys("counts"), g))
    joined = joined.withColumn("gaps", gaps)
    empty = lambda f: F.coalesce(F.get("gaps", 0), F.try_element_at("unread", f), F.lit("not_extracted"))
    joined = joined.withColumn("field_states", F.map_from_entries(F.transform(strings(FIELDS), lambda f: F.struct(f, F.coalesce(F.try_element_at("found", f), empty(f))))))
    reasons = F.concat("gaps", F.filter(strings(FURTHER), lambda r: F.array_contains(F.map_values("field_states"), r)))
    joined = joined.withColumn("reasons", reasons)
    partial = (F.size("gaps") > 0) & F.array_contains(F.map_values("field_states"), "confirmed")
    return joined.select("edition_id", "field_states", "reasons", first_in(F.col("reasons"), PRECEDENCE, "confirmed").alias("primary"), partial.alias("partial"), "counts")


def competition_diagnosis(competitions: DataFrame, checks: DataFrame, editions: DataFrame) -> DataFrame:
    """competition, primary, reasons, notices, current_notices. competitions: competition; checks: url, competition,
    edition_id, identity_state, conflicts (array); editions: competition, edition_id, current, reasons."""
    seen = checks.groupBy("competition").agg(F.count("*").alias("notices"), F.bool_or(F.col("identity_state") == "needs_review").alias("unsure"), F.bool_or(F.size("conflicts") > 0).alias("clash"))
    now = editions.filter("current").groupBy("competition").agg(F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("edition_id", "reasons"))), lambda x: x["reasons"]))).alias("found"))
    current = checks.join(editions.filter("current").select("edition_id"), "edition_id", "left_semi").groupBy("competition").agg(F.count("*").alias("current_notices"))
    joined = competitions.join(seen, "competition", "left").join(now, "competition", "left").join(current, "competition", "left")
    missing = facts.flagged(("no_current_notice", F.lit(True)), ("identity_unknown", F.coalesce("unsure", F.lit(False))), ("identity_conflict", F.coalesce("clash", F.lit(False))))
    reasons = F.when(F.col("notices").isNull(), strings(["no_notices"])).when(F.col("found").isNull(), missing).otherwise(F.col("found"))
    primary = F.when(F.col("notices").isNull(), "no_notices").when(F.col("found").isNull(), "no_current_notice").otherwise(first_in(F.col("found"), PRECEDENCE, "confirmed"))
    return joined.select("competition", primary.alias("primary"), reasons.alias("reasons"), F.coalesce("notices", F.lit(0)).alias("notices"), F.coalesce("current_notices", F.lit(0)).alias("current_notices"))


def shown_status(status: Column, primary: Column, has_current: Column, edition_states: Column) -> Column:
    """Status of registration as shown: the reason that nothing is known in place of it. edition_states: the states of
    the current editions (array)."""
    gaps = [g for g in PRECEDENCE if g not in ("conflict", "needs_review")]
    gap = first_in(edition_states, gaps, "")
    open_question = status.isin("needs_review", "not_mentioned") & ~F.array_contains(edition_states, "needs_review") & ~F.array_contains(edition_states, "conflict") & (gap != "")
    return F.when(~has_current, primary).when(open_question, gap).otherwise(status)


def missing_report(diagnosed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(label, n) of primary reasons and of all reasons, zero where there is none."""
    primary = reports.zero_filled(diagnosed.select(F.col("primary").alias("label")), "label", [x for x in LABELS if x != "identity_unknown"])
    reasons = reports.zero_filled(diagnosed.select(F.explode("reasons").alias("label")), "label", [x for x in LABELS if x != "confirmed"])
    return primary, reasons


def fetch_coverage(checks: DataFrame) -> DataFrame:
    """total, success, failed, empty, pending, with_fields, rate (four places, null if there is nothing), of checks (url,
    status, has_fields); a url counts once."""
    one = checks.groupBy("url").agg(F.max(F.coalesce("status", F.lit("pending"))).alias("status"), F.bool_or("has_fields").alias("has_fields"))
    made = one.agg(F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in ("success", "failed", "empty", "pending")], F.count_if("has_fields").alias("with_fields"))
    return made.withColumn("rate", F.round(F.col("success") / F.nullif("total", F.lit(0)), 4))


