"""Typed dates in notices, each with the place that it was read from.

Python finds the matches of a pattern, for built-in functions give no offsets, and carries on what a date takes from
the one before it; all other decisions are expressions over the array of a text's matches. Work goes by the number of
matches: what stands around one is cut at AROUND characters, and what holds for a whole sentence is looked up once there.
"""

from __future__ import annotations

import datetime
import re
from bisect import bisect_left
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.dates import clock

#: What ends a sentence, what ends a clause.
BREAKS = r"[\n。；;]"
MARKS = r"[，,。；;]"
#: Dates with and without a year, months with a year and ranges of such, clock times, and range marks.
DATE = r"(?<!\d)(?:(20\d{2})\s*[年./-]\s*(\d{1,2})\s*[月./-]|(\d{1,2})\s*[月./])\s*(\d{1,2})(?![\d月])\s*日?"
MONTHS = r"(20\d{2})[年./-](\d{1,2})月?\s*(?:至|到|—|–|-|~|～)\s*(?:(20\d{2})[年./-])?(\d{1,2})月|(20\d{2})[年./-](\d{1,2})月(?!\s*\d)"
CLOCK = r"^\s*(?:北京时间\s*)?(?:[（(][^）)]*[）)]\s*)?(上午|下午|晚上|晚间|中午|凌晨|早上|傍晚)?\s*(\d{1,2})\s*(?:[:：]\s*(\d{2})|[时点]\s*(?:(\d{1,2})\s*分?|(半))?)"
RANGE = r"^\s*(?:至|到|—|–|-|~|～)\s*$"
RANGE_DAY = r"^\s*(?:至|到|—|–|-|~|～)\s*(\d{1,2})日"
#: Words that decide a date's kind and flags.
UNRELATED = r"学籍|入学|选课|报到|学费"
SUBMISSION = r"(?i)作品|论文|材料|PPT|报名表|报送|提交|上传|递交"
REGISTRATION = r"报名|注册|登记|申报"
FROM_NOW = r"即日起\s*(?:至|到)"
STARTS = r"开始|启动|开放|起|自|从"
ENDS_BEFORE = r"截止|截至|结束"
ENDS = r"截止|截至|结束|最迟|之前|日前|前完成|前报名"
CAMPUS, OFFICIAL = r"校内|本校|学校", r"官方|组委会|全国|大赛官网"
CONTEST = r"比赛|竞赛|初赛|复赛|决赛|国赛|省赛|选拔赛"
CHANGED = r"延期|延至|延长|推迟|调整|变更"
VAGUE = r"前后|暂定|初定|拟定|待定|预计|另行通知|以.*通知为准"
NEXT_YEAR = r"次年|翌年|明年"
REVISED_TO = r"(?:延期|延长|推迟|调整|变更|延)(?:至|到|为)\s*$"
DEADLINES = ("registration_deadline", "campus_deadline", "official_deadline")

#: Characters that are kept on either side of a match.
AROUND = 1000

EVENT = "struct<kind:string,value:string,time:string,end_value:string,raw:string,start:int,end:int,begin:int,before:string,after:string,whole:boolean,flags:array<string>>"


def spans(c: Column, pattern: str, breaks: str = BREAKS, told: dict[str, str] | None = None, earlier: dict[str, str] | None = None) -> Column:
    """array<struct<raw, start, groups, begin, before, after, ..>>: the matches of the pattern (Python's), trimmed, each with
    its place in code points, where its sentence begins, and the rest of the sentence on both sides, AROUND characters at
    most. Null texts have none. told, earlier: name -> pattern, further booleans: whether the whole sentence has it, and
    whether it does before the match."""
    wanted, ends = re.compile(pattern), re.compile(breaks)
    whole = {n: re.compile(p) for n, p in (told or {}).items()}
    first = {n: re.compile(p) for n, p in (earlier or {}).items()}
    more = "".join(f",{n}:boolean" for n in (*whole, *first))

    @F.arrow_udf(f"array<struct<raw:string,start:int,groups:array<string>,begin:int,before:string,after:string{more}>>")
    def run(texts: pa.Array) -> pa.Array:
        counts, raws, starts, groups, begins, befores, afters = [0], [], [], [], [], [], []
        flags: dict[str, list[bool]] = {n: [] for n in (*whole, *first)}
        for text in texts.to_pylist():
            found = list(wanted.finditer(text)) if text else []
            cuts = [m.start() for m in ends.finditer(text)] if found else []
            known: tuple[int, int] | None = None
            for m in found:
                raw, start = m.group().rstrip(), m.start()
                stop = start + len(raw)
                i, j = bisect_left(cuts, start), bisect_left(cuts, stop)
                begin, end = cuts[i - 1] + 1 if i else 0, cuts[j] if j < len(cuts) else len(text)
                if known != (begin, end) and flags:
                    known, sentence = (begin, end), text[begin:end]
                    has = {n: p.search(sentence) is not None for n, p in whole.items()}
                    ahead = {n: begin + x.end() if (x := p.search(sentence)) else len(text) + 1 for n, p in first.items()}
                for n in whole:
                    flags[n].append(has[n])
                for n in first:
                    flags[n].append(ahead[n] <= start)
                raws.append(raw)
                starts.append(start)
                groups += m.groups()
                begins.append(begin)
                befores.append(text[max(begin, start - AROUND) : start])
                afters.append(text[stop : min(end, stop + AROUND)])
            counts.append(len(raws))
        each = pa.ListArray.from_arrays(pa.array(range(0, len(groups) + 1, max(1, wanted.groups)) if wanted.groups else [0] * (len(raws) + 1), pa.int32()), pa.array(groups, pa.string()))
        columns = [pa.array(raws, pa.string()), pa.array(starts, pa.int32()), each, pa.array(begins, pa.int32()), pa.array(befores, pa.string()), pa.array(afters, pa.string())]
        columns += [pa.array(x, pa.bool_()) for x in flags.values()]
        return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.StructArray.from_arrays(columns, names=["raw", "start", "groups", "begin", "before", "after", *flags]))

    return run(c)


def last_part(c: Column, marks: str) -> Column:
    """What stands behind the last of the marks."""
    return F.element_at(F.split(c, marks), -1)


def first_part(c: Column, marks: str) -> Column:
    return F.split(c, marks, 2)[0]


CARRIED = "array<struct<kind:string,linked:boolean,start_year:int,range_year:int>>"


def carried(matches: pa.Array) -> pa.Array:
    """What a date takes from the one before it in its sentence: a range's end, or a date that is moved, its kind; a range's
    end without a year that of the beginning, or the next where its month is an earlier one."""
    out = []
    for row in matches.to_pylist():
        made, near = [], None
        for m in row or []:
            same = near is not None and near["begin"] == m["begin"]
            linked = same and bool(m["linked"])
            kind = near["kind"] if linked or same and m["moved"] else m["kind"]
            start_year, start_month = near["at"] if same else (None, None)
            range_year = start_year + (m["month"] < start_month) if linked and not m["whole"] and start_year is not None and m["month"] is not None else None
            year = m["year"] if range_year is None else range_year
            try:
                datetime.date(year, m["month"], m["day"])
                at = (year, m["month"])
            except (TypeError, ValueError):
                at = (None, None)
            near = {"begin": m["begin"], "kind": kind, "at": at}
            made.append({"kind": kind, "linked": linked, "start_year": start_year, "range_year": range_year})
        out.append(made)
    return pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("linked", pa.bool_()), ("start_year", pa.int32()), ("range_year", pa.int32())])))


def clock_after(after: Column) -> Column:
    """struct<time, bad>: the clock time (HH:MM, 24:00 allowed) that the text begins with, and whether it is impossible."""
    part = lambda i: F.regexp_extract(after, CLOCK, i)

    def timed(c: Column) -> Column:
        hour, period = c["hour"], c["period"]
        minute = F.coalesce(c["minute"], F.when(c["half"], 30).otherwise(0))
        hour = F.when(period.isin("下午", "晚上", "晚间", "傍晚") & (hour < 12), hour + 12).when((period == "中午") & (hour < 11), hour + 12).when(period.isin("上午", "凌晨") & (hour == 12), 0).otherwise(hour)
        return let(clock(hour, minute, F.lit("am")), lambda time: F.struct(time.alias("time"), time.isNull().alias("bad")))

    read = F.struct(part(1).alias("period"), part(2).try_cast("int").alias("hour"), F.coalesce(part(3).try_cast("int"), part(4).try_cast("int")).alias("minute"), (part(5) != "").alias("half"))
    none = F.struct(F.lit(None).cast("string").alias("time"), F.lit(False).alias("bad"))
    return F.when(after.rlike(CLOCK), let(read, timed)).otherwise(none)


def day_of(year: Column, month: Column, day: Column) -> Column:
    """ISO string of the day, null where there is no such day."""
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    last = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return F.when(month.between(1, 12) & (day >= 1) & (day <= last) & (year > 0), F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), two(month), F.lit("-"), two(day)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of the value, which is worked out once."""
    return F.transform(F.array(value), body)[0]


def kind_of(before: Column, after: Column, context: Column | None = None) -> Column:
    """What a date is of, by the clauses around it: submission before registration before contests."""
    beside = F.lit("") if context is None else context

    def decided(c: Column) -> Column:
        prefix, near = c["prefix"], c["near"]
        starts = prefix.rlike(STARTS) & ~prefix.rlike(ENDS_BEFORE)
        deadline = F.when(near.rlike(CAMPUS), "campus_deadline").when(near.rlike(OFFICIAL), "official_deadline").otherwise("registration_deadline")
        registers = F.when(prefix.rlike(FROM_NOW), "registration_deadline").when(starts, "registration_start").when(near.rlike(ENDS), deadline)
        contest = F.when(near.rlike(CONTEST), "competition").otherwise("other")
        return F.when(near.rlike(UNRELATED), "other").when(near.rlike(SUBMISSION), "submission").otherwise(F.coalesce(F.when(near.rlike(REGISTRATION), registers), contest))

    clauses = F.struct(last_part(before, MARKS).alias("prefix"), first_part(after, MARKS).alias("suffix"))
    return let(let(clauses, lambda c: F.struct(c["prefix"].alias("prefix"), F.concat(beside, c["prefix"], c["suffix"]).alias("near"))), decided)


def flagged(*pairs: tuple[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in pairs]))


def date_events(df: DataFrame, text: str, published: str, out: str, context: str | None = None) -> DataFrame:
    """out: array<struct<kind, value, time, end_value, raw, start, end, begin, before, after, whole, flags>> of the dates
    in a text, in order: dates with a day first, then months.

    A date without a year takes that of `published` (an ISO day as string), which is flagged; a year goes on only where
    the text says so or a range passes the new year. The end of a range has the kind of its beginning; a range of
    registration is a start and a deadline. begin is where the sentence begins; start and end are code points. A fact
    without flags is as the text has it, all others need review. Words in `context` count as those of each sentence.
    """
    day_published = F.coalesce(F.col(published).cast("string"), F.lit(""))
    beside = F.lit("") if context is None else F.coalesce(context, F.lit(""))

    def plain(m: Column, i: Column) -> Column:
        g = lambda i: m["groups"][i].try_cast("int")
        own = g(0)
        year = F.coalesce(own, F.regexp_extract(day_published, r"^(\d{4})-\d{2}-\d{2}", 1).try_cast("int"))
        later = own.isNull() & m["later"]
        near = F.when(i > 0, F.get("days__", i - 1))
        gap = F.right(m["before"], F.greatest(m["start"] - near["start"] - F.length(near["raw"]), F.lit(0)))
        linked = F.coalesce((near["begin"] == m["begin"]) & gap.rlike(RANGE), F.lit(False))

        def made(c: Column) -> Column:
            return F.struct(
                m["raw"].alias("raw"), m["start"].alias("start"), m["begin"].alias("begin"), m["before"].alias("before"), m["after"].alias("after"),
                own.isNotNull().alias("whole"), (year + c["later"].cast("int")).alias("year"), F.coalesce(g(1), g(2)).alias("month"), g(3).alias("day"), c["later"].alias("later"),
                c["kind"].alias("kind"), c["clock"]["time"].alias("time"), c["clock"]["bad"].alias("bad_time"), F.regexp_extract(m["after"], RANGE_DAY, 1).try_cast("int").alias("last"),
                m["changed"].alias("changed"), m["vague"].alias("vague"), c["linked"].alias("linked"), ((c["kind"] == "other") & last_part(m["before"], "[，,]").rlike(CHANGED)).alias("moved"),
            )

        return let(F.struct(later.alias("later"), kind_of(m["before"], m["after"], beside).alias("kind"), clock_after(m["after"]).alias("clock"), linked.alias("linked")), made)

    def dated(m: Column, i: Column) -> Column:
        """m with what it takes from the date before, and its day."""
        k = F.get("carried__", i)
        year = F.coalesce(k["range_year"], m["year"])
        return F.struct(k.alias("k"), year.alias("year"), day_of(year, m["month"], m["day"]).alias("value"), day_of(year, m["month"], m["last"]).alias("last"), m.alias("m"))

    def event(d: Column, i: Column) -> Column:
        at = lambda j: F.get("dated__", i + j) if j > 0 else F.when(i + j >= 0, F.get("dated__", i + j))
        own = d["m"]["begin"]
        same = lambda j: F.coalesce(at(j)["m"]["begin"] == own, F.lit(False))
        beyond = F.struct(
            d.alias("d"), same(-2).alias("b2"), same(-1).alias("b1"), same(1).alias("a1"), same(2).alias("a2"), at(1)["k"]["linked"].alias("linked"), at(1)["value"].alias("value"), at(-1)["m"]["whole"].alias("whole"),
            F.concat(beside, d["m"]["before"], d["m"]["raw"], d["m"]["after"]).alias("sentence"), F.coalesce(d["value"] < day_published, F.lit(False)).alias("early"), (d["m"]["last"].isNotNull() & d["value"].isNotNull()).alias("partial"),
        )

        def judged(x: Column) -> Column:
            d, m, k = x["d"], x["d"]["m"], x["d"]["k"]
            opens = x["a1"] & F.coalesce(x["linked"], F.lit(False))
            flags = flagged(
                ("missing_year", ~m["whole"]), ("cross_year", m["later"] | F.coalesce(k["range_year"] != k["start_year"], F.lit(False))), ("unknown_year", d["year"].isNull()),
                ("invalid_date", (d["year"].isNotNull() & d["value"].isNull()) | (x["partial"] & d["last"].isNull())), ("before_publication", x["early"]), ("possible_cross_year", x["early"] & ~m["whole"]),
                ("invalid_time", m["bad_time"]), ("postponed", m["changed"]), ("approximate", m["vague"]), ("range_endpoint", k["linked"]), ("date_range", x["partial"] | opens),
            )
            # A sentence with two dates, a range of registration: its start and its deadline.
            first, second = ~x["b1"] & x["a1"] & ~x["a2"], x["b1"] & ~x["b2"] & ~x["a1"]
            registers = (first & x["linked"] | second & k["linked"]) & x["sentence"].rlike(r"报名|注册|登记") & ~x["sentence"].rlike(r"作品|提交|报送|上传|比赛日期|决赛|初赛")
            end_value = F.when(opens, x["value"]).when(x["partial"], d["last"])
            whole = F.when(x["b1"], x["whole"]).otherwise(m["whole"])
            return let(F.struct(x.alias("x"), flags.alias("flags"), F.coalesce(registers, F.lit(False)).alias("registers"), (~x["b1"]).alias("first"), end_value.alias("end_value"), whole.alias("whole")), put)

        def put(y: Column) -> Column:
            d, m, r, first = y["x"]["d"], y["x"]["d"]["m"], y["registers"], y["first"]
            sentence = y["x"]["sentence"]
            deadline = F.when(sentence.rlike(r"校内|本校"), "campus_deadline").when(sentence.rlike(r"官方|组委会"), "official_deadline").otherwise("registration_deadline")
            settled = F.when(~y["whole"], F.array().cast("array<string>")).when(first, F.array(F.lit("before_publication"))).otherwise(F.array(F.lit("missing_year"), F.lit("unknown_year"), F.lit("possible_cross_year")))
            mended = F.array_except(y["flags"], F.concat(F.array(F.lit("date_range"), F.lit("range_endpoint")), settled))
            return F.struct(
                F.when(r & first, "registration_start").when(r, deadline).otherwise(d["k"]["kind"]).alias("kind"), d["value"].alias("value"), m["time"].alias("time"), F.when(~(r & first), y["end_value"]).alias("end_value"), m["raw"].alias("raw"), m["start"].alias("start"),
                (m["start"] + F.length(m["raw"])).alias("end"), m["begin"].alias("begin"), m["before"].alias("before"), m["after"].alias("after"), m["whole"].alias("whole"), F.when(r, mended).otherwise(y["flags"]).alias("flags"),
            ).cast(EVENT)

        return let(beyond, judged)

    def month(m: Column) -> Column:
        g = lambda i: m["groups"][i].try_cast("int")
        fine = F.coalesce(g(1), g(5)).between(1, 12) & F.coalesce(g(3), F.lit(1)).between(1, 12)
        flags = flagged(("month_precision", F.lit(True)), ("cross_year", F.coalesce(g(2) != g(0), g(3) < g(1), F.lit(False))), ("invalid_date", ~fine))
        none = F.lit(None).cast("string")
        return F.struct(
            kind_of(m["before"], m["after"]).alias("kind"), none.alias("value"), none.alias("time"), none.alias("end_value"), m["raw"].alias("raw"), m["start"].alias("start"), (m["start"] + F.length(m["raw"])).alias("end"),
            m["begin"].alias("begin"), m["before"].alias("before"), m["after"].alias("after"), F.lit(True).alias("whole"), flags.alias("flags"),
        ).cast(EVENT)

    # Generating a column keeps what is long to work out from being repeated by later projections and filters.
    once = lambda d, name, c: d.select("*", F.inline(F.array(F.struct(c.alias(name)))))
    found = df.withColumn("days__", spans(F.col(text), DATE, told={"changed": CHANGED, "vague": VAGUE}, earlier={"later": NEXT_YEAR})).withColumn("months__", spans(F.col(text), MONTHS))
    made = once(found, "plain__", F.transform("days__", plain))
    slim = F.transform("plain__", lambda m: F.struct(*[m[n].alias(n) for n in ("begin", "linked", "moved", "kind", "whole", "year", "month", "day")]))
    made = once(made.withColumn("carried__", F.arrow_udf(carried, CARRIED)(slim)), "dated__", F.transform("plain__", dated))
    every = F.concat(F.transform("dated__", event), F.transform("months__", month))
    return made.select(*[F.col(f"`{c}`") for c in df.columns if c != out], F.inline(F.array(F.struct(every.alias(out)))))
