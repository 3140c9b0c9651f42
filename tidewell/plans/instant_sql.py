"""The timestamp reader in DuckDB SQL, for the oracles of all queries on event time.

``INSTANTS`` is a list of CTEs that ends in ``timed``: every row of
fact_behavioral_event with event_timestamp_us and ingested_at_us. Each distinct
(text, zone) is read once, by one regular expression a notation.
"""

from __future__ import annotations

_CLOCK = r"(\d{1,2}):(\d\d)(?::(\d\d)(?:[.,](\d{1,9}))?)?"
_ZONE = r"([Zz]|[A-Za-z]+(?:/[A-Za-z0-9_+\-]+)*|[+-]\d\d(?::?\d\d)?)?(?:\[([^\]]*)\])?"
_MON = "['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec']"
#: notation, its form, and which field each group is
_FORMS = (
    ("iso", rf"(\d{{4}})-(\d\d)-(\d\d)(?:[Tt ]{_CLOCK})? *{_ZONE}", "y m d h mi s f z b"),
    ("basic", rf"(\d{{4}})(\d\d)(\d\d)[Tt](\d\d)(\d\d)(\d\d)?(?:[.,](\d{{1,9}}))? *{_ZONE}", "y m d h mi s f z b"),
    ("dotted", rf"(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}})(?:,? +{_CLOCK})? *{_ZONE}", "d m y h mi s f z b"),
    ("slashed", rf"(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:,? +{_CLOCK})? *{_ZONE}", "m d y h mi s f z b"),
    ("mail", rf"(?:[A-Za-z]{{3,9}}, *)?(\d{{1,2}}) ([A-Za-z]{{3}})[a-z]* (\d{{4}})(?: +{_CLOCK})? *{_ZONE}", "d m y h mi s f z b"),
    ("us", rf"([A-Za-z]{{3}})[a-z]*\.? (\d{{1,2}}), (\d{{4}})(?:,? +{_CLOCK} *([AaPp][Mm])?)?", "m d y h mi s f ap"),
)
_WHITE = "' \t\n\r\f\u000b\u00a0'"


def _fields(form: str, groups: str) -> str:
    names = groups.split()
    r = f"regexp_extract(t, '^(?:{form})$', [{', '.join(repr(g) for g in names)}])"
    own = f"(SELECT {{{', '.join(repr(k) + ': ' + ('r.' + k if k in names else chr(39) * 2) for k in ('y', 'm', 'd', 'h', 'mi', 's', 'f', 'z', 'b', 'ap'))}}} FROM (SELECT {r} AS r))"
    return own


_CASES = "\n".join(f"    WHEN regexp_full_match(t, '{form}') THEN {{'kind': '{kind}', 'x': {_fields(form, groups)}}}" for kind, form, groups in _FORMS)

INSTANTS = f"""
zones AS (SELECT name FROM pg_timezone_names()),
src AS (
  SELECT *, coalesce((SELECT name FROM zones WHERE name = trim(origin_zone, {_WHITE})), 'UTC') AS own_zone FROM fact_behavioral_event
), texts AS (
  SELECT s, zone, trim(s, {_WHITE}) AS t FROM (SELECT DISTINCT event_timestamp AS s, own_zone AS zone FROM src UNION SELECT DISTINCT ingested_at, 'UTC' FROM src) WHERE s IS NOT NULL
), read AS (
  SELECT s, zone, t, CASE
{_CASES} END AS p FROM texts
), parts AS (
  SELECT s, zone, t, p.kind AS kind, p.x.y AS y,
    coalesce(try_cast(p.x.m AS INT), nullif(list_position({_MON}, lower(p.x.m)), 0)) AS a, try_cast(p.x.d AS INT) AS b,
    coalesce(try_cast(nullif(p.x.h, '') AS BIGINT), 0) AS h12, upper(p.x.ap) AS ap, coalesce(try_cast(nullif(p.x.mi, '') AS BIGINT), 0) AS mi, coalesce(try_cast(nullif(p.x.s, '') AS BIGINT), 0) AS sec,
    rpad(left(p.x.f, 6), 6, '0')::BIGINT AS us, p.x.z || p.x.b AS z
  FROM read
), dated AS (
  SELECT *, CASE WHEN kind <> 'slashed' THEN a WHEN a > 12 THEN b WHEN b > 12 OR a = b THEN a END AS mo, CASE WHEN kind = 'slashed' AND a > 12 THEN a ELSE b END AS da,
    CASE WHEN ap = '' THEN h12 WHEN h12 BETWEEN 1 AND 12 THEN h12 % 12 + CASE WHEN ap = 'PM' THEN 12 ELSE 0 END END AS h,
    length(z) <= 3 AND upper(left(z, 3)) IN ('Z', 'UTC', 'GMT') OR upper(left(z, 3)) = 'ZUT' AS is_utc, left(z, 1) IN ('+', '-') AS signed
  FROM parts
), localized AS (
  SELECT s, zone, t, is_utc, signed, z,
    CASE WHEN z = '' OR is_utc OR signed OR z IN (SELECT name FROM zones) THEN
      epoch_us(try_cast(y || '-' || lpad(mo::VARCHAR, 2, '0') || '-' || lpad(da::VARCHAR, 2, '0') AS DATE)::TIMESTAMP)
      + CASE WHEN h <= 23 AND mi <= 59 AND sec <= 59 THEN h * 3600000000 + mi * 60000000 + sec * 1000000 + us END END AS lus,
    CASE WHEN signed THEN regexp_extract(z, '^([+-])(\\d\\d):?(\\d\\d)?', ['g', 'h', 'm']) END AS o
  FROM dated
), placed AS (
  SELECT *, make_timestamp(lus) AS l, CASE WHEN z <> '' AND NOT is_utc AND NOT signed THEN z ELSE zone END AS at_zone,
    CASE WHEN is_utc THEN 0 WHEN signed AND try_cast(o.h AS INT) <= 18 AND coalesce(try_cast(nullif(o.m, '') AS INT), 0) <= 59
      THEN CASE WHEN o.g = '-' THEN -1 ELSE 1 END * (o.h::INT * 60 + coalesce(try_cast(nullif(o.m, '') AS INT), 0)) * 60000000::BIGINT END AS off
  FROM localized
), zoned AS (
  SELECT *, CASE WHEN off IS NULL AND NOT signed AND lus IS NOT NULL THEN list_distinct(list_filter(
      [epoch_us(timezone(at_zone, l)) + k::BIGINT * 1800000000 for k in [-2, -1, 0, 1, 2]], lambda u: epoch_us(timezone(at_zone, make_timestamptz(u))) = lus)) END AS cands
  FROM placed
), inst AS (
  SELECT s, zone, CASE
    WHEN regexp_full_match(t, '\\d{{10}}(\\.\\d{{1,9}})?') THEN left(t, 10)::BIGINT * 1000000 + rpad(left(substr(t, 12), 6), 6, '0')::BIGINT
    WHEN regexp_full_match(t, '\\d{{13}}') THEN t::BIGINT * 1000 WHEN regexp_full_match(t, '\\d{{16}}') THEN t::BIGINT
    WHEN signed OR is_utc THEN lus - off WHEN len(cands) = 1 THEN cands[1] END AS us
  FROM zoned
), timed AS (
  SELECT src.* EXCLUDE (own_zone), e.us AS event_timestamp_us, i.us AS ingested_at_us
  FROM src LEFT JOIN inst e ON src.event_timestamp = e.s AND src.own_zone = e.zone LEFT JOIN inst i ON src.ingested_at = i.s AND i.zone = 'UTC'
)
"""
