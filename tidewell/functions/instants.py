"""Reading timestamps of many notations as expressions that stay in the JVM.

``with_parsed`` turns a string column into three

    _local      wall-clock microseconds since 1970, null if the value is unreadable
    _offset     offset from UTC the value itself names (0 for bare numbers), else null
    _zone       zone name the value itself names, else null

``with_utc`` makes them instants. Each notation costs one regular expression: it is rewritten to one text of fixed
fields that is then split, instead of one match for every field.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.ids import WHITE

SECOND, MINUTE, HOUR, DAY = 1_000_000, 60_000_000, 3_600_000_000, 86_400_000_000

_TIME = r"(\d{1,2}):(\d\d)(?::(\d\d)(?:[.,](\d{1,9}))?)?"
_ZONE = r"([Zz]|[A-Za-z]+(?:/[A-Za-z0-9_+\-]+)*|[+-]\d\d(?::?\d\d)?)?(?:\[([^\]]*)\])?"
_ISO = rf"^(\d{{4}})-(\d\d)-(\d\d)(?:[Tt ]{_TIME})? *{_ZONE}$"
_BASIC = rf"^(\d{{4}})(\d\d)(\d\d)[Tt](\d\d)(\d\d)(\d\d)?(?:[.,](\d{{1,9}}))? *{_ZONE}$"
_DOTTED = rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}})(?:,? +{_TIME})? *{_ZONE}$"
_SLASHED = rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:,? +{_TIME})? *{_ZONE}$"
_MAIL = rf"^(?:[A-Za-z]{{3,9}}, *)?(\d{{1,2}}) ([A-Za-z]{{3}})[a-z]* (\d{{4}})(?: +{_TIME})? *{_ZONE}$"
_US = rf"^([A-Za-z]{{3}})[a-z]*\.? (\d{{1,2}}), (\d{{4}})(?:,? +{_TIME} *([AaPp][Mm])?)?$"
CANONICAL = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z$"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


@lru_cache(maxsize=4)
def _zones(_app: str) -> tuple[str, ...]:
    spark = SparkSession.getActiveSession()
    return tuple(sorted(str(z) for z in spark._jvm.java.time.ZoneId.getAvailableZoneIds()))


def known_zones() -> list[str]:
    """Region names of the time zone database in the JVM, about 600."""
    return list(_zones(SparkSession.getActiveSession().sparkContext.applicationId))


def _number(c: Column) -> Column:
    """Microseconds of a bare number: seconds (10 digits, with or without a
    fraction), milliseconds (13) or microseconds (16)."""
    whole = F.split_part(c, F.lit("."), F.lit(1))
    fraction = F.substring(F.rpad(F.split_part(c, F.lit("."), F.lit(2)), 6, "0"), 1, 6)
    n = F.length(whole)
    return (
        F.when(n == 10, whole.try_cast("bigint") * SECOND + fraction.try_cast("bigint"))
        .when((n == 13) & (F.length(c) == 13), whole.try_cast("bigint") * 1000)
        .when((n == 16) & (F.length(c) == 16), whole.try_cast("bigint"))
    )


def _fields(c: Column) -> Column:
    """Year, month, day, hour, minute, second, fraction, zone and half of the day as texts."""
    t = F.btrim(c, F.lit(WHITE))
    iso = "$1;$2;$3;$4;$5;$6;$7;$8$9;"
    # "+02:00[Europe/Berlin]" comes out as "+02:00Europe/Berlin"; the offset is cut off by its form below.
    return F.split(
        F.when(F.substring(t, 5, 1) == "-", F.regexp_replace(t, _ISO, iso))
        .when(F.substring(t, 3, 1).isin("/") | (F.substring(t, 2, 1) == "/"), F.regexp_replace(t, _SLASHED, "$3;$1/;$2;$4;$5;$6;$7;$8$9;"))
        .when(F.substring(t, 3, 1).isin(".") | (F.substring(t, 2, 1) == "."), F.regexp_replace(t, _DOTTED, "$3;$2;$1;$4;$5;$6;$7;$8$9;"))
        .when(F.upper(F.substring(t, 9, 1)) == "T", F.regexp_replace(t, _BASIC, iso))
        .when(t.rlike(r"^\d{10,16}(\.\d{1,9})?$"), F.concat(F.lit("#;;;;;;;"), t, F.lit(";")))
        .when(t.rlike(r"^[A-Za-z]{3}[a-z]*\.? \d"), F.regexp_replace(t, _US, "$3;$1;$2;$4;$5;$6;$7;;$8"))
        .otherwise(F.regexp_replace(t, _MAIL, "$3;$2;$1;$4;$5;$6;$7;$8$9;")),
        ";",
    )


def _once(c: Column) -> Column:
    """The same value, computed once. A filter on a computed column is otherwise
    pushed below it with the whole computation written out for every mention;
    the optimizer does not do that with an expression that isn't deterministic."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


def with_parsed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds for each (new name, string column) the columns ``<name>_local``,
    ``<name>_offset`` and ``<name>_zone``. Null, blank and unreadable values,
    impossible dates and times, and slashed dates that read as two dates give a
    null local time.

    The texts of fields are one projection, their numbers the next, the result a
    third: plain columns that are used more than once, which the optimizer leaves
    as they are, so that each regular expression runs once a value. The stage has
    long expressions; ``session.prepare`` keeps its methods compilable."""
    names = df.columns
    df = df.withColumns({f"__{k}_f": _fields(F.col(c)) for k, c in columns.items()})
    stage: dict[str, Column] = {}
    for k in columns:
        g = lambda i, k=k: F.get(F.col(f"__{k}_f"), F.lit(i))
        # A cast that fails raises and catches inside, which costs more than all else here: none is tried on a text that can't be a number.
        digit = lambda x: F.substring(x, 1, 1).between("0", "9")
        number = lambda x: F.when(digit(x), x.try_cast("bigint")).when(x == "", F.lit(0))
        stage |= {
            f"__{k}_kind": F.when(g(0) == "#", F.lit("#")).when(g(1).endswith("/"), F.lit("/")).when(F.size(f"__{k}_f") == 9, F.lit("-")),
            f"__{k}_y": g(0),
            f"__{k}_a": F.coalesce(
                F.when(digit(g(1)), F.rtrim(g(1), F.lit("/")).try_cast("int")),
                F.when(F.length(g(1)) == 3, ((F.instr(F.lit(_MONTHS), F.lower(g(1))) + 2) / 3).cast("int")),
            ),
            f"__{k}_d": F.when(digit(g(2)), g(2).try_cast("int")),
            f"__{k}_n": F.when(g(0) == "#", g(7)),
            f"__{k}_h": number(g(3)),
            f"__{k}_mi": number(g(4)),
            f"__{k}_s": number(g(5)),
            f"__{k}_us": F.substring(F.rpad(g(6), 6, "0"), 1, 6).try_cast("bigint"),
            f"__{k}_z": g(7),
            f"__{k}_half": F.upper(g(8)),
        }
    df = df.select(*names, *[v.alias(c) for c, v in stage.items()])
    out: dict[str, Column] = {}
    for k in columns:
        c = lambda x, k=k: F.col(f"__{k}_{x}")
        a, d, z = c("a"), c("d"), c("z")
        slashed = c("kind") == "/"
        month = F.when(~slashed, a).when(a > 12, d).when((d > 12) | (a == d), a)
        day = F.when(slashed & (a > 12), a).otherwise(d)
        two = lambda x: F.lpad(x.cast("string"), 2, "0")
        days = F.unix_date(F.concat(c("y"), F.lit("-"), two(month), F.lit("-"), two(day)).try_cast("date"))
        hour = F.when(c("half") == "", c("h")).when(c("h").between(1, 12), c("h") % 12 + F.when(c("half") == "PM", 12).otherwise(0))
        clock = F.when((hour <= 23) & (c("mi") <= 59) & (c("s") <= 59), hour * F.lit(HOUR) + c("mi") * F.lit(MINUTE) + c("s") * F.lit(SECOND) + c("us"))
        head = F.upper(F.substring(z, 1, 3))
        utc = (F.length(z) <= 3) & head.isin("Z", "UTC", "GMT") | (head == "ZUT")
        signed = F.substring(z, 1, 1).isin("+", "-")
        digits = F.replace(F.regexp_extract(z, r"^[+-](\d\d(?::?\d\d)?)", 1), F.lit(":"), F.lit(""))
        oh, om = F.substring(digits, 1, 2).try_cast("bigint"), F.coalesce(F.substring(digits, 3, 2).try_cast("bigint"), F.lit(0))
        offset = F.when((oh <= 18) & (om <= 59), F.when(F.substring(z, 1, 1) == "-", -1).otherwise(1) * (oh * F.lit(HOUR) + om * F.lit(MINUTE)))
        zero = F.lit(0).cast("bigint")
        out |= {
            f"{k}_local": F.when(c("kind") == "#", _number(c("n"))).when(
                # Fields of another notation, or a zone that is neither offset nor known, make the value unreadable.
                c("kind").isNotNull() & ((z == "") | utc | signed | z.isin(known_zones())),
                days * F.lit(DAY) + clock,
            ),
            f"{k}_offset": F.when((c("kind") == "#") | utc, zero).when(signed, offset),
            f"{k}_zone": F.when((c("kind") != "#") & (z != "") & ~utc & ~signed, z),
        }
    return df.select(*names, *[_once(v).alias(c) for c, v in out.items()])


def zone_offset_us(utc_us: Column, zone: Column) -> Column:
    """Offset of the zone at an instant."""
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(utc_us), zone)) - utc_us


def with_utc(df: DataFrame, columns: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds for each (new name, (parsed name, zone)) the microseconds since 1970
    UTC of a parsed value; ``zone`` counts where it names no zone of its own. A
    local time at which the zone's clocks stood never or twice gives null.

    The offsets a day before and a day after are the two that can hold at the
    instant (zones don't change twice within two days)."""
    names = df.columns
    local = lambda p: F.col(f"{p}_offset").isNull() & F.col(f"{p}_local").isNotNull()
    df = df.withColumns({f"__{n}_zone": F.when(local(p), F.coalesce(F.col(f"{p}_zone"), z)) for n, (p, z) in columns.items()})
    zoned = lambda n: F.col(f"__{n}_zone").isNotNull()
    df = df.withColumns(
        {
            f"__{n}_{side}": F.when(zoned(n), zone_offset_us(F.col(f"{p}_local") + shift, F.col(f"__{n}_zone")))
            for n, (p, _) in columns.items()
            for side, shift in (("before", -DAY), ("after", DAY))
        }
    )
    out = {}
    for n, (p, _) in columns.items():
        us, before, after, zone = F.col(f"{p}_local"), F.col(f"__{n}_before"), F.col(f"__{n}_after"), F.col(f"__{n}_zone")
        first = zone_offset_us(us - before, zone) == before
        second = zone_offset_us(us - after, zone) == after
        out[n] = (
            F.when(F.col(f"{p}_offset").isNotNull(), us - F.col(f"{p}_offset"))
            .when(before == after, us - before)
            .when(first & ~second, us - before)
            .when(second & ~first, us - after)
        )
    return df.select(*names, *[_once(v).alias(c) for c, v in out.items()])
