"""Decision lists: rules in order, of which the first that holds decides, with its reason; and that of notices by title.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import text
from tidewell.operators import dictionary

#: Types of notices by their titles, in order of precedence; types that one can sign up for, and types that
#: speak of the past; words that a page about a contest has.
TYPES = [
    ("postponement", r"延期|延长.*(?:报名|截止)|(?:报名|截止).*延长|时间调整"),
    ("award", r"获奖|荣获|斩获|喜报|获.*等奖|获.*冠军"),
    ("results", r"结果公示|获奖名单|评审结果|成绩公示"),
    ("recruitment", r"招募|招新|队员选拔"),
    ("training", r"培训|集训|训练营|宣讲"),
    ("registration", r"报名|参赛通知|竞赛通知|大赛通知|比赛通知"),
]
SIGNUP, PAST = ("registration", "recruitment", "postponement"), ("award", "results")
EVIDENCE = r"(?i)竞赛|比赛|大赛|挑战杯|招募|战队|建模|电赛|robot|icpc|蓝桥"


def first_match(rules: list[tuple[Column, dict[str, object]]], other: dict[str, object]) -> Column:
    """struct of the values of the first rule that holds, in order; a null condition doesn't hold. Rules and `other` give
    values of the same names."""
    made = lambda values: F.struct(*[F.lit(values[n]).alias(n) for n in other])
    return F.coalesce(*[F.when(condition, made(values)) for condition, values in rules], made(other))


def types_of(title: Column) -> Column:
    """array<struct<type, start, end, raw>>: the types that a title speaks of, in order of precedence, and where."""

    def one(name: str, pattern: str) -> Column:
        raw, start = F.regexp_substr(title, F.lit(pattern)), F.regexp_instr(title, F.lit(pattern)) - 1
        return F.when(raw.isNotNull(), F.struct(F.lit(name).alias("type"), start.alias("start"), (start + F.char_length(raw)).alias("end"), raw.alias("raw")))

    return F.array_compact(F.array(*[one(*t) for t in TYPES]))


def classified(notices: DataFrame, names: DataFrame, classes: tuple[str, ...], exclusions: DataFrame | None = None, tracks: list[tuple[str, str]] | None = None) -> DataFrame:
    """notices (url, title, body, status, ..) with matches (array of target, category, name), state, reason, types, primary,
    eligible and requires_review.

    names: name, target, category, rank - names of competitions as they may stand in titles, of any number. A title that
    names one competition of a target class is a target, one that names several is for review, one that names only one of
    another class is excluded, and so is a page that was read and has no word of a contest. exclusions: as in
    dictionary.all_links. tracks (pattern of target, word): of these competitions only a notice with the word counts.
    Award and result notices are never eligible."""
    keyed = notices.select("url", text.classifier_key(F.coalesce("title", F.lit(""))).alias("key_title"))
    plain = names.select(text.classifier_key(F.col("name")).alias("name"), "target", "rank")
    links = dictionary.all_links(keyed, "url", "key_title", plain, exclusions)
    of = names.groupBy("target").agg(F.min("category").alias("category"))
    hits = links.join(of, "target").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("target", "category", "name"))).alias("matches"))  # as many as a title names
    joined = notices.join(hits, F.col("url") == F.col("key"), "left").drop("key").withColumn("matches", F.coalesce("matches", F.array().cast("array<struct<target:string,category:string,name:string>>")))
    whole = F.concat(F.coalesce("title", F.lit("")), F.coalesce("body", F.lit("")))
    n, one = F.size("matches"), F.get("matches", F.lit(0))
    wanted = (n == 1) & one["category"].isin(*classes)
    open_track = F.lit(False)
    for pattern, word in tracks or ():
        open_track = open_track | (one["target"].rlike(pattern) & ~F.contains(whole, F.lit(word)))
    verdict = first_match(
        [
            (wanted & open_track, {"state": "review", "reason": "track_unconfirmed"}),
            (wanted, {"state": "target", "reason": "unique_title_match"}),
            (n > 1, {"state": "review", "reason": "multiple_competitions"}),
            (n == 1, {"state": "excluded", "reason": "outside_target_catalog"}),
            ((F.col("status") == "success") & ~whole.rlike(EVIDENCE), {"state": "excluded", "reason": "no_competition_evidence"}),
        ],
        {"state": "review", "reason": "insufficient_evidence"},
    )
    made = joined.withColumn("verdict__", verdict).withColumn("types", types_of(F.coalesce("title", F.lit(""))))
    primary = F.coalesce(F.get("types", F.lit(0))["type"], F.lit("unknown"))
    past = F.exists("types", lambda t: t["type"].isin(*PAST))
    made = made.withColumns({"state": F.col("verdict__.state"), "reason": F.col("verdict__.reason"), "primary": primary})
    return made.withColumns({"eligible": (F.col("state") == "target") & F.col("primary").isin(*SIGNUP) & ~past, "requires_review": (F.col("state") == "review") | (F.col("primary") == "unknown")}).drop("verdict__")
