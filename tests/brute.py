"""Plain row-by-row versions of what SQL can't say, for tests on small tables."""

from __future__ import annotations

import re
from collections import defaultdict
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo, available_timezones

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
ZONES = available_timezones()
WHITE = " \t\n\r\f\v\u00a0"
MON = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
CANON = re.compile(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z")


def micros(t: datetime) -> int:
    return (t - EPOCH) // timedelta(microseconds=1)


def norm(s: str | None) -> str | None:
    return (s or "").strip(WHITE).upper() or None


def from_local(t: datetime, zone: str) -> int | None:
    """By trying both folds and reading them back."""
    z = ZoneInfo(zone)
    good = set()
    for fold in (0, 1):
        u = t.replace(tzinfo=z, fold=fold).astimezone(UTC)
        if u.astimezone(z).replace(tzinfo=None) == t:
            good.add(micros(u))
    return good.pop() if len(good) == 1 else None


def instant(text: str | None, zone: str) -> int | None:
    """Microseconds of the one instant a text denotes."""
    if text is None:
        return None
    s = text.strip(WHITE)
    if re.fullmatch(r"\d{10}(\.\d{1,9})?", s):
        a, _, b = s.partition(".")
        return int(a) * 10**6 + int((b + "000000")[:6])
    if re.fullmatch(r"\d{13}", s):
        return int(s) * 1000
    if re.fullmatch(r"\d{16}", s):
        return int(s)
    clock = r"(?P<h>\d{1,2}):(?P<mi>\d\d)(?::(?P<s>\d\d)(?:[.,](?P<f>\d{1,9}))?)?"
    tail = r" *(?P<z>[Zz]|UTC|GMT|utc|gmt|[+-]\d\d(?::?\d\d)?|[A-Z]\w+(?:/\w+)+)?(?:\[(?P<b>[^\]]*)\])?"
    forms = [
        r"(?P<y>\d{4})-(?P<m>\d\d)-(?P<d>\d\d)(?:[Tt ]" + clock + ")?" + tail,
        r"(?P<y>\d{4})(?P<m>\d\d)(?P<d>\d\d)[Tt](?P<h>\d\d)(?P<mi>\d\d)(?P<s>\d\d)?(?:[.,](?P<f>\d{1,9}))?" + tail,
        r"(?P<d>\d{1,2})\.(?P<m>\d{1,2})\.(?P<y>\d{4})(?:,? +" + clock + ")?" + tail,
        r"(?P<p>\d{1,2})/(?P<q>\d{1,2})/(?P<y>\d{4})(?:,? +" + clock + ")?" + tail,
        r"(?:[A-Za-z]{3,9}, *)?(?P<d>\d{1,2}) (?P<mon>[A-Za-z]{3})[a-z]* (?P<y>\d{4})(?: +" + clock + ")?" + tail,
        r"(?P<mon>[A-Za-z]{3})[a-z]*\.? (?P<d>\d{1,2}), (?P<y>\d{4})(?:,? +" + clock + r" *(?P<ap>[AaPp][Mm])?)?",
    ]
    for form in forms:
        m = re.fullmatch(form, s)
        if not m:
            continue
        g = defaultdict(lambda: None, m.groupdict())
        h, hf = int(g["h"] or 0), (g["ap"] or "").lower()
        if hf:
            if not 1 <= h <= 12:
                return None
            h = h % 12 + (12 if hf == "pm" else 0)

        def make(month: int, day: int) -> datetime | None:
            try:
                return datetime(int(g["y"]), month, day, h, int(g["mi"] or 0), int(g["s"] or 0), int(((g["f"] or "") + "000000")[:6]))
            except ValueError:
                return None

        if g["p"]:
            two = {make(int(g["p"]), int(g["q"])), make(int(g["q"]), int(g["p"]))} - {None}
            if len(two) != 1:
                return None
            t = two.pop()
        else:
            month = MON.get(g["mon"].lower()) if g["mon"] else int(g["m"])
            t = make(month, int(g["d"])) if month else None
        if t is None:
            return None
        z = g["z"] or g["b"]
        if not z:
            return from_local(t, zone)
        if z.upper() in ("Z", "UTC", "GMT"):
            return micros(t.replace(tzinfo=UTC))
        if z[0] in "+-":
            n = z[1:].replace(":", "")
            off = timedelta(hours=int(n[:2]), minutes=int(n[2:] or 0))
            return micros(t.replace(tzinfo=UTC)) - (1 if z[0] == "+" else -1) * (off // timedelta(microseconds=1))
        return from_local(t, z) if z in ZONES else None
    return None


def event_instants(r: dict) -> tuple[int | None, int | None]:
    zone = (r["origin_zone"] or "").strip()
    return instant(r["event_timestamp"], zone if zone in ZONES else "UTC"), instant(r["ingested_at"], "UTC")


def p4(rows: list[dict]) -> set:
    out = set()
    for r in rows:
        for name, us in zip(("event_timestamp", "ingested_at"), event_instants(r), strict=True):
            if us is not None and not CANON.fullmatch(r[name]):
                out.add((r["event_key"], name, us))
    return out


def event_times(r: dict) -> tuple[int | None, int | None]:
    """(event time, arrival)"""
    e, i = event_instants(r)
    k = r["kafka_timestamp"] and micros(r["kafka_timestamp"])
    return (k if e is None else e), (i if k is None else k)


def day_sk(us: int) -> int:
    return int((EPOCH + timedelta(microseconds=us)).strftime("%Y%m%d"))


def p1(rows: list[dict]) -> set:
    out = set()
    for r in rows:
        e, a = event_times(r)
        if e is not None and a is not None and day_sk(a) > day_sk(e) and a - e <= 72 * 3600 * 10**6:
            out.add((r["event_key"], day_sk(e)))
    return out


def p5(rows: list[tuple], parents: list[tuple], stones: dict) -> set:
    """rows (id, reference, time), parents (key, time), stones {key: latest time}"""
    seen = defaultdict(list)
    for k, t in parents:
        seen[k].append(t)
    out = set()
    for i, ref, t in rows:
        if norm(i) is None or ref is None:
            continue
        have = [x for x in seen[ref] if x is not None] if ref in seen else None
        gone = stones.get(ref)
        if gone is not None and (have is None or have and gone > max(have)):
            out.add((norm(i), "deleted"))
        elif have is None:
            out.add((norm(i), "missing"))
        elif have and t is not None and min(have) > t:
            out.add((norm(i), "late"))
    return out
