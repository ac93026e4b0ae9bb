"""Editions of competitions: which edition a notice is of, what its dates say over time, and what is open now.

All tables are flat: notices by url, events by (url, kind, ..), slots by (competition, edition, kind, track, phase, stage).
The year of publication is never taken for that of a competition; what can't be told apart stays apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import facts
from tidewell.functions.facts import let

#: Names of editions, phases in order of precedence, stages, and types of notices by their titles.
ROUND = r"第([一二三四五六七八九十百零〇\d]+)届"
YEAR = r"(?<!\d)(20\d{2})(?=年|年度|赛季|\s|第|中国|全国|[“\"（）()_-]|$)"
SEASON = r"(?<!\d)(20\d{2})\s*[-—–/]\s*(20\d{2})\s*(?:年|赛季|$)"
PHASES = [("campus", r"校内选拔|校内赛|校赛|校内初赛|校内决赛"), ("provincial", r"省赛|省级赛|省级选拔"), ("national", r"全国赛|国赛|全国总决赛"), ("final", r"总决赛|决赛"), ("semifinal", r"复赛"), ("preliminary", r"初赛")]
STAGE = r"第([一二三四五六七八九十\d]+)(阶段|轮)"
TYPES = [("postponement", r"延期|延长|推迟|延至"), ("results", r"公示|获奖|结果|名单公布|成绩公布"), ("supplement", r"补充|补报|更正|调整|变更"), ("registration", r"报名|注册|申报|选拔|参赛|组织参加")]
#: Contexts in which a named edition isn't the notice's own, and words of references.
HISTORY = r"往年|往届|上届|回顾|历届|曾于|为迎接|为备战|准备参加"
PAST_REFERENCE, REFERENCE = r"历史|往届|上届|去年", r"通知|本届|本次|延期|补充|根据|参照"
FINAL_RESULTS, EARLY_RESULTS = r"获奖|成绩|结果", r"报名审核|资格审核|初审|拟推荐|候选"
NOISE = r"[\s“”\"‘’]"
CLUE = "struct<year:int,year_end:int,edition:int>"


def first_of(c: Column, rules: list[tuple[str, str]], other: str | None = None) -> Column:
    """Name of the first rule whose pattern the text has."""
    return F.coalesce(*[F.when(c.rlike(pattern), F.lit(name)) for name, pattern in rules], F.lit(other))


def round_number(c: Column) -> Column:
    """A Chinese or Arabic ordinal below 1000 as int; null where a character is neither."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("digit"), F.lit(True).alias("fine"))

    def add(s: Column, x: Column) -> Column:
        digit = F.position(x, F.lit("零一二三四五六七八九")) - 1
        value = F.when(x == "〇", 0).when(digit >= 0, digit)
        unit = F.when(x == "十", 10).when(x == "百", 100)
        total = F.when(unit.isNotNull(), s["total"] + F.greatest(s["digit"], F.lit(1)) * unit).otherwise(s["total"])
        return F.struct(total.alias("total"), F.coalesce(value, F.lit(0)).alias("digit"), (s["fine"] & (value.isNotNull() | unit.isNotNull())).alias("fine"))

    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int")).otherwise(F.aggregate(chars, start, add, lambda s: F.when(s["fine"], s["total"] + s["digit"])))


def stage_in(c: Column, phase: Column) -> Column:
    """A numbered stage, or within a campus, provincial or national phase its preliminary, semi-final or final."""
    number = round_number(F.regexp_extract(c, STAGE, 1))
    within = F.when(phase.isin("campus", "national", "provincial"), F.nullif(F.regexp_extract(c, r"初赛|复赛|决赛", 0), F.lit("")))
    return F.when(c.rlike(STAGE), F.concat(F.lit("第"), F.coalesce(number.cast("string"), F.regexp_extract(c, STAGE, 1)), F.regexp_extract(c, STAGE, 2))).otherwise(within)


def identity(title: Column) -> Column:
    """struct<year, year_end, edition, ambiguous, phase, stage, notice_type> that a title states. A season counts as its
    first year; several years or editions make it ambiguous, and leave that member null."""
    t = F.coalesce(title, F.lit(""))
    season = t.rlike(SEASON)
    years = F.when(season, F.array(F.regexp_extract(t, SEASON, 1))).otherwise(F.array_distinct(F.regexp_extract_all(t, F.lit(YEAR), 1)))
    rounds = F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(ROUND), 1), round_number))

    def made(x: Column) -> Column:
        year = F.when(F.size(x["years"]) == 1, x["years"][0].cast("int"))
        end = F.when(season, F.regexp_extract(t, SEASON, 2).cast("int")).otherwise(year)
        return F.struct(
            year.alias("year"), end.alias("year_end"), F.when(F.size(x["rounds"]) == 1, x["rounds"][0]).alias("edition"), ((F.size(x["years"]) > 1) | (F.size(x["rounds"]) > 1)).alias("ambiguous"),
            x["phase"].alias("phase"), stage_in(t, x["phase"]).alias("stage"), first_of(t, TYPES, "announcement").alias("notice_type"),
        )

    return let(F.struct(years.alias("years"), rounds.alias("rounds"), first_of(t, PHASES).alias("phase")), made)


def scoped_clues(raw: Column, names: Column) -> Column:
    """array<struct<year, year_end, edition>>: years and editions that the text ties to one of the names (array), looking
    70 characters back in the clause and 65 ahead. What is told of earlier editions doesn't count."""
    t = F.regexp_replace(F.coalesce(raw, F.lit("")), NOISE, "")

    def clue(before: Column, after: Column) -> Column:
        edition = round_number(F.nullif(F.regexp_extract(before, ROUND + r"[（()）]*$", 1), F.lit("")))
        prefix = F.regexp_replace(before, ROUND + r"[（()）]*$", "")
        own = F.nullif(F.regexp_extract(prefix, r"(?<!\d)(20\d{2})(?:年|年度)?[（()）]*$", 1), F.lit(""))
        held = F.regexp_extract(prefix, r"(20\d{2})年[^。；;，,]{0,28}(?:举办|举行|组织参加)$", 0)
        held_year = F.when(F.size(F.array_distinct(F.regexp_extract_all(held, F.lit(r"20\d{2}"), 0))) == 1, F.substring(held, 1, 4))
        behind = F.nullif(F.regexp_extract(after, r"^[（(](20\d{2})[）)]", 1), F.lit(""))
        planned = F.nullif(F.regexp_extract(after, r"^(?:将|拟)?(?:定)?于(20\d{2})年[^。；;]{0,30}(?:举办|举行|开展|召开)", 1), F.lit(""))
        seasons = r"(20\d{2})[-—–/](20\d{2})(?:年|赛季)?[（()）]*$"
        first, last = (F.nullif(F.regexp_extract(prefix, seasons, i), F.lit("")).try_cast("int") for i in (1, 2))
        year = F.coalesce(first, F.coalesce(own, held_year, behind, planned).try_cast("int"))
        found = F.when(~before.rlike(HISTORY) & (year.isNotNull() | edition.isNotNull()), F.struct(year.alias("year"), F.coalesce(last, year).alias("year_end"), edition.alias("edition")).cast(CLUE))
        return found

    def of_name(name: Column) -> Column:
        parts = F.split(t, F.concat(F.lit(r"\Q"), name, F.lit(r"\E")))

        def at(i: Column) -> Column:
            joined = lambda some: F.aggregate(some, F.lit(None).cast("string"), lambda s, x: F.when(s.isNull(), x).otherwise(F.concat(s, name, x)))
            before = F.right(F.regexp_extract(joined(F.slice(parts, F.lit(1), i)), r"[^，,。；;：:《》]*$", 0), F.lit(70))
            after = F.left(joined(F.slice(parts, i + 1, F.size(parts))), F.lit(65))
            return let(F.struct(before.alias("b"), after.alias("a")), lambda x: clue(x["b"], x["a"]))

        return F.when((F.length(name) >= 4) & (F.size(parts) > 1), F.transform(F.sequence(F.lit(1), F.size(parts) - 1), at)).otherwise(F.array().cast(f"array<{CLUE}>"))

    plain = F.array_distinct(F.filter(F.transform(names, lambda n: F.regexp_replace(n, NOISE, "")), lambda n: n.isNotNull() & (n != "")))
    return F.array_compact(F.flatten(F.transform(plain, of_name)))


def identity_sentences(body: Column) -> Column:
    """Sentences that may say of which edition a text is: with a year or an edition, and a word of contests."""
    parts = F.transform(F.split(F.coalesce(body, F.lit("")), r"\n|(?<=[。；;])"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x.rlike(r"20\d{2}|第.*届") & x.rlike(r"竞赛|大赛|挑战赛"))


def refined_identity(notices: DataFrame, title: str, body: str, names: str) -> DataFrame:
    """Adds `identity`: that of the title, made sure by what title and body tie to the names (array) of the competition;
    conflicts (array of year, edition) name what is told in several ways, method is title or title_body."""
    found = notices.withColumn("base__", identity(F.col(title))).withColumn("own__", scoped_clues(F.col(title), F.col(names)))
    found = found.withColumn("told__", F.flatten(F.transform(identity_sentences(F.col(body)), lambda x: scoped_clues(x, F.col(names)))))

    def values(member: str) -> Column:
        of = lambda clues: F.array_compact(F.transform(clues, lambda c: c[member]))
        base = F.when(F.size("own__") > 0, of(F.col("own__"))).otherwise(F.array_compact(F.array(F.col(f"base__.{member}"))))
        return F.array_distinct(F.concat(base, of(F.col("told__"))))

    found = found.withColumn("years__", values("year")).withColumn("editions__", values("edition"))
    ambiguous = (F.size("years__") > 1) | (F.size("editions__") > 1) | (F.col("base__.ambiguous") & (F.size("own__") == 0))
    year = F.when(F.size("years__") == 1, F.col("years__")[0])
    ends = F.transform(F.filter(F.concat("own__", "told__"), lambda c: c["year"] == F.col("years__")[0]), lambda c: c["year_end"])
    end = F.when(F.size("years__") == 1, F.array_max(F.concat(ends, F.array(F.col("years__")[0]), F.array_compact(F.array(F.when((F.size("own__") == 0) & (F.size("told__") == 0), F.col("base__.year_end")))))))
    conflicts = F.when(ambiguous, facts.flagged(("year", F.size("years__") > 1), ("edition", F.size("editions__") > 1))).otherwise(F.array().cast("array<string>"))
    made = F.struct(
        year.alias("year"), end.alias("year_end"), F.when(F.size("editions__") == 1, F.col("editions__")[0]).alias("edition"), ambiguous.alias("ambiguous"), F.col("base__.phase").alias("phase"), F.col("base__.stage").alias("stage"),
        F.col("base__.notice_type").alias("notice_type"), conflicts.alias("conflicts"), F.when(F.size("told__") > 0, "title_body").otherwise("title").alias("method"),
    )
    return found.withColumn("identity", made).drop("base__", "own__", "told__", "years__", "editions__")


def resolve_references(notices: DataFrame, references: DataFrame) -> DataFrame:
    """notices (url, competition, year, year_end, edition, ambiguous, track, method) with what linked notices of the same
    competition tell where a year or edition is missing. references: (url, target, raw).

    Only unambiguous notices with a year are believed, only if the link's words refer to this edition, and only if all
    that are linked tell the same. What differs from the notice's own year or edition makes it ambiguous. Each notice is
    judged by what is known before this step, so the order of rows doesn't matter.
    """
    open_ones = notices.filter(~F.col("ambiguous") & ~(F.col("year").isNotNull() & F.col("edition").isNotNull()))
    anchors = notices.filter(~F.col("ambiguous") & F.col("year").isNotNull()).select(F.col("url").alias("target"), *[F.col(c).alias(f"to_{c}") for c in ("competition", "year", "year_end", "edition", "track")])
    usable = references.filter(~F.col("raw").rlike(PAST_REFERENCE) & F.col("raw").rlike(REFERENCE) & (F.col("url") != F.col("target")))
    pairs = open_ones.join(usable, "url").join(anchors, "target").filter("competition = to_competition and (track is null or to_track is null or track = to_track)")
    told = pairs.groupBy("url").agg(F.collect_set(F.struct("to_year", "to_edition", "to_year_end")).alias("told")).filter(F.size("told") == 1).select("url", F.col("told")[0].alias("told"))
    joined = notices.join(told, "url", "left")
    clash = F.coalesce((F.col("year") != F.col("told.to_year")) | F.coalesce(F.col("edition") != F.col("told.to_edition"), F.lit(False)), F.lit(False)) | F.coalesce(F.col("edition").isNotNull() & F.col("told").isNotNull() & ~F.col("edition").eqNullSafe(F.col("told.to_edition")), F.lit(False))
    takes = F.col("told").isNotNull() & ~clash
    over = {c: F.when(takes, F.col(f"told.to_{c}")).otherwise(F.col(c)) for c in ("year", "year_end", "edition")}
    over |= {"ambiguous": F.col("ambiguous") | clash, "method": F.when(takes, "explicit_reference").otherwise(F.col("method"))}
    return joined.select(*[over.get(c, F.col(c)).alias(c) for c in notices.columns])


def assign_editions(notices: DataFrame) -> DataFrame:
    """Adds edition_year, edition_no, edition_id, identity_state and identity_method to notices (url, competition, year,
    edition, ambiguous, track, method).

    A notice with only a year or an edition takes both from the anchors (notices with both) of its competition and track,
    if exactly one pair fits. A notice that is ambiguous or names neither is an edition of its own."""
    both = ~F.col("ambiguous") & F.col("year").isNotNull() & F.col("edition").isNotNull()
    anchors = notices.filter(both).select("competition", "track", F.col("year").alias("a_year"), F.col("edition").alias("a_edition")).distinct()
    some = notices.filter(~F.col("ambiguous") & (F.col("year").isNotNull() | F.col("edition").isNotNull())).select("url", "competition", "track", "year", "edition").alias("n")
    fits = F.expr("n.competition = a.competition and n.track <=> a.track and (n.year is null or n.year = a_year) and (n.edition is null or n.edition = a_edition)")
    bridge = some.join(anchors.alias("a"), fits).groupBy("n.url").agg(F.collect_set(F.struct("a_year", "a_edition")).alias("pairs")).filter(F.size("pairs") == 1).select("url", F.col("pairs")[0].alias("bridge"))
    joined = notices.join(bridge, "url", "left")
    year, number = F.coalesce("bridge.a_year", "year"), F.coalesce("bridge.a_edition", "edition")
    unknown = F.col("ambiguous") | (year.isNull() & number.isNull())
    key = F.when(unknown, F.concat(F.lit("unknown:"), "url")).otherwise(F.concat_ws(":", F.coalesce(year.cast("string"), F.lit("-")), F.coalesce(number.cast("string"), F.lit("-"))))
    bridged = F.col("bridge").isNotNull() & ~(F.col("year").eqNullSafe(F.col("bridge.a_year")) & F.col("edition").eqNullSafe(F.col("bridge.a_edition")))
    made = joined.withColumns({
        "edition_year": F.when(~unknown, year), "edition_no": F.when(~unknown, number), "edition_id": F.substring(F.sha2(F.concat_ws("|", "competition", key).cast("binary"), 256), 1, 16),
        "identity_state": F.when(year.isNotNull() & ~F.col("ambiguous"), "confirmed").otherwise("needs_review"), "identity_method": F.when(bridged, "explicit_anchor").otherwise(F.col("method")),
    })
    return made.drop("bridge")


ENTRY = "struct<url:string,date:string,value:string,time:string,end_value:string,raw:string,flags:array<string>,verification:string>"
CHANGE = "struct<url:string,old:array<string>,status:string>"
STATE = f"struct<entries:array<{ENTRY}>,history:array<{ENTRY}>,applied:bigint,pending:bigint,changes:array<{CHANGE}>>"


def entry_state(entries: Column) -> Column:
    """conflict, needs_review, confirmed or not_mentioned, of the entries of a slot."""
    sure = F.filter(entries, lambda e: e["verification"] == "source_matched")
    values = F.array_distinct(F.transform(sure, lambda e: F.struct(e["value"], e["time"], e["end_value"])))
    clash = F.exists(entries, lambda e: F.array_contains(e["flags"], "conflict")) | (F.size(values) > 1)
    return F.when(clash, "conflict").when(F.size(sure) != F.size(entries), "needs_review").when(F.size(entries) > 0, "confirmed").otherwise("not_mentioned")


SLOT = ("competition", "edition_id", "kind", "track", "phase", "stage")


def slots(notices: DataFrame, events: DataFrame) -> DataFrame:
    """competition, edition_id, kind, track, phase, stage, entries, history, applied, pending, changes, state: what each date
    of an edition is by now, after its notices in the order of (date, url). changes: which notice revised what of which.

    notices: url, date, competition, edition_id, phase, stage. events: as notices.events gives them, by url; a track is
    optional. A revision ("moved to ..") takes the place of the earlier value, which goes to the history, only if that is
    one confirmed value of an earlier notice and agrees with the old date that the revision states; else it stays beside
    it, for review. Only the events of a slot are gathered, which are as many as its notices tell.
    """
    return folded(placed(notices, events).groupBy(*SLOT).agg(F.sort_array(F.collect_list("event")).alias("events")))


def placed(notices: DataFrame, events: DataFrame) -> DataFrame:
    """The columns of SLOT and `event`, a struct that sorts by date, url and place, for each date of an edition."""
    if "track" not in events.columns:
        events = events.withColumn("track", F.lit(None).cast("string"))
    about = notices.select("url", "date", "competition", "edition_id", F.col("phase").alias("own_phase"), F.col("stage").alias("own_stage"))
    clause = F.concat(F.regexp_extract("before", r"[^，,。；;\n]*$", 0), "raw", F.regexp_extract("after", r"^[^，,。；;\n]*", 0))
    found = events.filter("kind <> 'other'").join(about, "url").withColumn("clause__", clause).withColumn("phase", F.coalesce(first_of(F.col("clause__"), PHASES), "own_phase"))
    found = found.withColumn("stage", F.coalesce(stage_in(F.col("clause__"), F.col("phase")), "own_stage")).withColumn("sentence", F.concat("before", "raw", "after"))
    several = F.size(F.array_distinct(F.regexp_extract_all("sentence", F.lit(STAGE), 0))) > 1
    found = found.withColumn("flags", F.when(several, F.array_union("flags", F.array(F.lit("scope_ambiguous")))).otherwise(F.col("flags"))).withColumn("verification", F.when(several, "needs_review").otherwise(F.col("verification")))
    # Dates of one sentence, kind and track: which of them it revises, and to what.
    near = found.groupBy("url", "kind", "track", "sentence", "begin").agg(F.bool_or("revises").alias("sibling"), F.collect_set(F.when(F.col("superseded"), F.struct("value", "time"))).alias("declared"))
    same = ["url", "kind", "sentence", "begin"]
    found = found.join(near.withColumnRenamed("track", "near_track"), same).filter("track <=> near_track")
    event = F.struct("date", "url", "start", "value", "time", "end_value", F.col("sentence").alias("raw"), "flags", "verification", "superseded", "revises", "sibling", "declared")
    return found.select(*SLOT, event.alias("event"))


def folded(gathered: DataFrame) -> DataFrame:
    """Slots of gathered events (SLOT, events: array of `event` of placed, sorted)."""

    def without(e: Column, *flags: str) -> tuple[Column, Column]:
        rest = F.array_except(e["flags"], F.array(*[F.lit(f) for f in flags]))
        fine = e["value"].isNotNull() & (F.size(rest) == 0)
        return F.when(fine, rest).otherwise(e["flags"]), F.when(fine, "source_matched").otherwise(e["verification"])

    def entry(e: Column, flags: Column, verification: Column) -> Column:
        return F.struct(e["url"], e["date"], e["value"], e["time"], e["end_value"], e["raw"], flags.alias("flags"), verification.alias("verification")).cast(ENTRY)

    def add(s: Column, e: Column) -> Column:
        old_flags, old_verification = without(e, "postponed", "conflict", "before_publication")
        new_flags, new_verification = without(e, "postponed", "conflict")
        declared = e["superseded"] & e["sibling"] & ~e["revises"]
        known = F.exists(s["entries"], lambda x: x["value"].eqNullSafe(e["value"]) & x["time"].eqNullSafe(e["time"]))
        values = F.array_distinct(F.transform(s["entries"], lambda x: F.struct(x["value"].alias("value"), x["time"].alias("time"))))
        ordered = F.forall(s["entries"], lambda x: (x["date"] < e["date"]) | ((x["url"] == e["url"]) & (x["raw"] == e["raw"])))
        agrees = (F.size(e["declared"]) == 0) | ((F.size(values) == 1) & (F.size(e["declared"]) == 1) & F.array_contains(e["declared"], values[0]))
        applies = e["revises"] & (F.size(values) == 1) & (entry_state(s["entries"]) == "confirmed") & ordered & agrees & (new_verification == "source_matched")
        fails = e["revises"] & ~applies
        flags = F.when(declared, old_flags).when(fails, F.array_union(e["flags"], F.array(F.lit("unresolved_revision")))).otherwise(e["flags"])
        verification = F.when(declared, old_verification).when(fails, "needs_review").otherwise(e["verification"])

        def put(x: Column) -> Column:
            entries = F.when(x["applies"], F.array(x["new"])).when(x["past"] | F.array_contains(s["entries"], x["now"]), s["entries"]).otherwise(F.concat(s["entries"], F.array(x["now"])))
            history = F.when(x["applies"], F.concat(s["history"], s["entries"])).when(x["past"], F.concat(s["history"], F.array(x["now"]))).otherwise(s["history"])
            change = F.struct(e["url"].alias("url"), F.transform(s["entries"], lambda o: o["url"]).alias("old"), F.when(x["applies"], "applied").otherwise("needs_review").alias("status"))
            changes = F.when(x["applies"] | x["fails"], F.array_append(s["changes"], change.cast(CHANGE))).otherwise(s["changes"])
            return F.struct(entries.alias("entries"), history.alias("history"), (s["applied"] + x["applies"].cast("long")).alias("applied"), (s["pending"] + x["fails"].cast("long")).alias("pending"), changes.alias("changes")).cast(STATE)

        return let(F.struct(applies.alias("applies"), fails.alias("fails"), (declared & known).alias("past"), entry(e, flags, verification).alias("now"), entry(e, new_flags, new_verification).alias("new")), put)

    none = F.array().cast(f"array<{ENTRY}>")
    start = F.struct(none.alias("entries"), none.alias("history"), F.lit(0).cast("long").alias("applied"), F.lit(0).cast("long").alias("pending"), F.array().cast(f"array<{CHANGE}>").alias("changes")).cast(STATE)
    folded = gathered.withColumn("s", F.aggregate("events", start, add)).select(*[c for c in gathered.columns if c != "events"], "s.*")
    return folded.withColumn("state", entry_state(F.col("entries")))


def event_instant(value: Column, time: Column, is_start: Column) -> Column:
    """Timestamp (local time) of a day and a clock time: 24:00 is the next day, a start without time is at 00:00, anything
    else at 23:59:59; null for no day or an impossible one."""
    base = F.to_timestamp_ntz(F.date_format(F.try_to_date(value, "yyyy-MM-dd"), "yyyy-MM-dd"))
    seconds = F.when(time.isNull(), F.when(is_start, 0).otherwise(86399)).otherwise(F.substring(time, 1, 2).try_cast("int") * 3600 + F.substring(time, 4, 2).try_cast("int") * 60)
    return base + F.make_dt_interval(secs=seconds)


def slot_status(made: DataFrame, notices: DataFrame, now: Column) -> DataFrame:
    """The deadlines among the slots with status (open, closed, not_started or their state), instant, closed_by.

    A slot is closed by its deadline, or by a notice of results of its edition, phase, stage and track that is no older
    than it. It isn't started while a start of the same track, phase and stage lies ahead, and needs review while such a
    start does. notices: url, date, title, edition_id, notice_type, phase, stage, track.
    """
    final = notices.filter(F.col("notice_type") == "results").filter(F.col("title").rlike(FINAL_RESULTS) & ~F.col("title").rlike(EARLY_RESULTS)).select("edition_id", F.col("url").alias("by_url"), F.col("date").alias("by_date"), F.col("phase").alias("by_phase"), F.col("stage").alias("by_stage"), F.col("track").alias("by_track"))
    scope = lambda a, b: reduce(lambda x, y: x & y, (F.col(f"{a}{c}").eqNullSafe(F.col(f"{b}{c}")) for c in ("track", "phase", "stage")))
    deadlines = made.filter(F.col("kind").isin(*facts.DEADLINES)).withColumn("slot__", F.struct("edition_id", "kind", "track", "phase", "stage")).withColumn("last__", F.element_at("entries", -1))
    closing = deadlines.join(final, "edition_id").filter(scope("", "by_") & (F.col("by_date") >= F.col("last__.date"))).groupBy("slot__").agg(F.min(F.struct("by_date", "by_url")).getField("by_url").alias("closed_by"))
    starts = made.filter("kind = 'registration_start'").select("edition_id", F.col("track").alias("s_track"), F.col("phase").alias("s_phase"), F.col("stage").alias("s_stage"), (F.col("state") != "confirmed").alias("unsure"), F.exists("entries", lambda e: event_instant(e["value"], e["time"], F.lit(True)) > now).alias("ahead"))
    begun = deadlines.join(starts, "edition_id").filter(scope("", "s_")).groupBy("slot__").agg(F.bool_or("unsure").alias("unsure"), F.bool_or(F.coalesce("ahead", F.lit(False))).alias("ahead"))
    joined = deadlines.join(closing, "slot__", "left").join(begun, "slot__", "left").withColumn("instant", event_instant(F.col("last__.value"), F.col("last__.time"), F.lit(False)))
    sure = F.when(F.coalesce("unsure", F.lit(False)) | F.col("instant").isNull(), "needs_review").when(F.col("closed_by").isNotNull() | (F.col("instant") <= now), "closed").when(F.coalesce("ahead", F.lit(False)), "not_started").otherwise("open")
    return joined.withColumn("status", F.when(F.col("state") == "confirmed", sure).otherwise(F.col("state"))).drop("slot__", "last__", "unsure", "ahead")


def edition_registration(status: DataFrame, editions: DataFrame) -> DataFrame:
    """editions (edition_id, complete) with deadline_state, status, next_deadline (the first open slot's value) and
    open_nodes: what the deadlines of an edition come to. An edition without any is not_mentioned if all its notices were
    read, else it needs review."""
    has = lambda c, s: F.bool_or(F.col(c) == s)
    state = F.when(has("state", "conflict"), "conflict").when(has("state", "needs_review"), "needs_review").otherwise("confirmed")
    every = lambda s: F.bool_and(F.col("status") == s)
    rolled = F.when(has("status", "open"), "open").when(every("not_started"), "not_started").when(every("closed"), "closed").otherwise("needs_review")
    node = F.struct("instant", "kind", "track", "phase", "stage", F.element_at("entries", -1)["value"].alias("value"), F.element_at("entries", -1)["url"].alias("url"))
    made = status.groupBy("edition_id").agg(state.alias("deadline_state"), rolled.alias("rolled"), F.sort_array(F.collect_list(F.when(F.col("status") == "open", node))).alias("open_nodes"))
    joined = editions.join(made, "edition_id", "left")
    missing = F.when(F.col("complete"), "not_mentioned").otherwise("needs_review")
    joined = joined.withColumn("deadline_state", F.coalesce("deadline_state", missing))
    joined = joined.withColumn("status", F.when(F.col("deadline_state") == "confirmed", F.col("rolled")).otherwise(F.col("deadline_state"))).drop("rolled")
    return joined.withColumn("next_deadline", F.when(F.col("status") == "open", F.element_at(F.transform("open_nodes", lambda n: n["value"]), 1)))


def current_editions(editions: DataFrame, now: Column) -> DataFrame:
    """Adds `current` to editions (competition, edition_id, identity_state, year, year_end, first_date): those of the
    latest year among the confirmed ones that aren't over by year and have a notice by now. Several of that year stay."""
    eligible = (F.col("identity_state") == "confirmed") & (F.coalesce("year_end", "year") >= F.year(now)) & (F.coalesce("first_date", F.lit("")) <= F.date_format(now, "yyyy-MM-dd"))
    latest = editions.filter(eligible).groupBy("competition").agg(F.max("year").alias("latest__"))
    return editions.join(latest, "competition", "left").withColumn("current", F.coalesce(eligible & (F.col("year") == F.col("latest__")), F.lit(False))).drop("latest__")


def competition_registration(editions: DataFrame) -> DataFrame:
    """competition, status, next_deadline, current_ids from editions (competition, edition_id, identity_state, current,
    status, open_nodes): open over conflict over needs_review, closed or not_started if all current ones are."""
    now = F.col("current")
    any_of = lambda s: F.bool_or(now & (F.col("status") == s))
    all_of = lambda s: F.bool_and(~now | (F.col("status") == s))
    first = F.min(F.when(now & (F.col("status") == "open"), F.col("open_nodes")[0]))
    rolled = F.when(any_of("open"), "open").when(any_of("conflict"), "conflict").when(any_of("needs_review"), "needs_review").when(all_of("closed"), "closed").when(all_of("not_started"), "not_started").otherwise("not_mentioned")
    none = F.when(F.bool_or(F.col("identity_state") != "confirmed"), "needs_review").otherwise("not_mentioned")
    made = editions.groupBy("competition").agg(F.bool_or(now).alias("any__"), rolled.alias("rolled__"), none.alias("none__"), first.alias("first__"), F.sort_array(F.collect_set(F.when(now, F.col("edition_id")))).alias("current_ids"))
    return made.select("competition", F.when(F.col("any__"), F.col("rolled__")).otherwise(F.col("none__")).alias("status"), F.col("first__.value").alias("next_deadline"), F.col("first__.url").alias("next_url"), "current_ids")


def field_state(facts_: Column, complete: Column) -> Column:
    """State of a field from its facts (array of struct with flags and verification)."""
    return (
        F.when(F.exists(facts_, lambda f: F.array_contains(f["flags"], "conflict")), "conflict").when(F.exists(facts_, lambda f: f["verification"] != "source_matched"), "needs_review").when(F.size(facts_) > 0, "confirmed")
        .when(complete, "not_mentioned").otherwise("needs_review")
    )
