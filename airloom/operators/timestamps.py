"""Mixed timestamp notations to one instant (whole epoch seconds).

The cascade is a list of anchored patterns, tried from the leading digit run
outwards; each pattern hands its fields to a strict constructor, so impossible
dates become NULL instead of rolling over.  Everything stays in built-in
expressions: no Python runs per row.

Policies for local times around clock changes:

* ``ambiguous`` (a local time that occurs twice): ``first``, ``last`` or ``null``.
* ``nonexistent`` (a local time that is skipped): ``forward`` (by the length of
  the gap, i.e. read with the offset before it) or ``null``.
"""

from __future__ import annotations

from collections.abc import Mapping
from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Zone abbreviations of schedule feeds and their offsets in minutes.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "SAST": 120, "PKT": 300, "IST": 330,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
# English month names by their first three letters.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"

# One pattern yields one comma list: year, month, day, hour, minute, second, half, zone.
_ZONE = r"(?:\s*([+-]\d{1,2}:?\d{2}|(?:UTC|GMT)[+-]\d{1,2}(?::?\d{2})?|[A-Za-z]+(?:/[A-Za-z_+-]+)+|[A-Z]{1,5}))?"
COMPACT = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})?" + _ZONE + "$"
ISO = r"^(\d{4})-(\d{2})-(\d{2})[T ](\d{2}):(\d{2})(?::(\d{2})(?:[.,]\d{1,9})?)?" + _ZONE + "$"
SLASH = r"^(\d{1,2})/(\d{1,2})/(\d{4}),? (\d{1,2}):(\d{2})(?::(\d{2}))?" + _ZONE + "$"
WORDS = r"^(\d{1,2}) ([A-Za-z]{3})[a-z]* (\d{4}),? (\d{1,2}):(\d{2})(?::(\d{2}))?(?: ?([AaPp])\.?[Mm]\.?)?" + _ZONE + "$"



def canonical(c: Column) -> Column:
    """True where the text is already ``YYYYMMDDHHMMSS +0000``."""
    return F.coalesce(c.rlike(r"^\d{14} \+0000$"), F.lit(False))


def _fields(s: Column) -> Column:
    """The comma list of the first pattern whose first characters fit; other texts stay as they are."""
    return (
        F.when(s.rlike(r"^\d{12}"), F.regexp_replace(s, COMPACT, "$1,$2,$3,$4,$5,$6,,$7"))
        .when(F.substring(s, 5, 1) == "-", F.regexp_replace(s, ISO, "$1,$2,$3,$4,$5,$6,,$7"))
        .when(F.instr(s, "/").between(2, 3), F.regexp_replace(s, SLASH, "$3,$2,$1,$4,$5,$6,,$7"))
        .otherwise(F.regexp_replace(s, WORDS, "$3,$2,$1,$4,$5,$6,$7,$8"))
    )


def _int(c: Column) -> Column:
    """Digits of a matched pattern; an absent group is NULL, without an exception on the way."""
    return F.when(c.rlike("^[0-9]+$"), c.cast("int"))


def _month(c: Column) -> Column:
    at = F.instr(F.lit(MONTHS), F.lower(c))
    return F.when(c.rlike("^[0-9]+$"), c.cast("int")).when((at > 0) & ((at - 1) % 4 == 0), F.floor((at - 1) / 4).cast("int") + 1)


def _hour(h: Column, half: Column) -> Column:
    """A twelve hour clock runs from 1 to 12; 12 AM is midnight."""
    n = _int(h)
    pm = F.when(F.lower(half) == "p", F.lit(12)).otherwise(F.lit(0))
    return F.when(half == "", n).when(n.between(1, 12), n % 12 + pm)


def _written_offset(zone: Column, abbreviations: Mapping[str, int]) -> Column:
    """Seconds east of UTC written in the text; NULL if the zone is a name, absent or senseless."""
    p = r"^(?:UTC|GMT)?([+-])(\d{1,2}?):?(\d{2})?$"
    hours = _int(F.regexp_extract(zone, p, 2))
    minutes = F.coalesce(_int(F.regexp_extract(zone, p, 3)), F.lit(0))
    sign = F.when(F.regexp_extract(zone, p, 1) == "-", F.lit(-60)).otherwise(F.lit(60))
    table = F.create_map(*[F.lit(x) for kv in abbreviations.items() for x in kv])
    return F.when(
        zone.rlike("[+-][0-9]"), F.when((hours <= 14) & (minutes < 60), sign * (hours * 60 + minutes))
    ).otherwise(F.try_element_at(table, zone) * 60)


def _to_utc(local: Column, zone: Column, ambiguous: str, nonexistent: str) -> Column:
    utc = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(local), zone))

    def shows(u: Column) -> Column:
        return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(u), zone)) == local

    out = utc
    if ambiguous != "first":
        later = F.coalesce(*[F.when(shows(utc + d), utc + d) for d in (3600, 1800, 7200)])
        out = F.when(later.isNull(), utc).otherwise(later if ambiguous == "last" else F.lit(None).cast("long"))
    if nonexistent == "null":
        out = F.when(shows(utc), out)
    return out


def normalise_instants(
    rows: DataFrame,
    zones: DataFrame,
    columns: Mapping[str, str],
    *,
    on: str = "source",
    zone: str = "tz_name",
    abbreviations: Mapping[str, int] = ABBREVIATIONS,
    ambiguous: str = "first",
    nonexistent: str = "forward",
) -> DataFrame:
    """Add a column of epoch seconds for each text column.

    rows: any columns, ``on`` and the text columns among them; all are kept, and
    an existing column of a new name is replaced.  zones: the default zone (IANA)
    per ``on``; a source without entry or with NULL counts as UTC, an unknown
    zone name makes its zoneless times NULL.  Parts of a second are cut off.
    NULL, empty, all-zero texts, words and impossible dates give NULL.  Empty
    input gives empty output; repeated rows stay repeated.
    """
    if ambiguous not in ("first", "last", "null") or nonexistent not in ("forward", "null"):
        raise ValueError("unknown policy for local times")
    names = sorted(available_timezones())
    tz, key = "__al_tz", "__al_on"
    small = zones.select(F.col(on).alias(key), F.col(zone).alias(tz)).dropDuplicates([key])
    out = rows.join(small, rows[on].eqNullSafe(small[key]), "left")
    # Small projections, one after the other: a pattern runs once per value, and
    # each generated method stays below the size that the JVM still compiles.
    for i, (old, new) in enumerate(columns.items()):
        v = f"__al_{i}"
        s, f, z = F.col(f"{v}s"), F.col(f"{v}f"), F.col(f"{v}z")
        get = lambda j, f=f: F.get(f, F.lit(j))
        out = out.withColumn(f"{v}s", F.trim(F.regexp_replace(old, r"[\s\u00a0]+", " ")))
        out = out.withColumn(f"{v}f", F.split(_fields(s), ","))
        out = out.withColumns({
            f"{v}day": F.when(F.size(f) == 8, F.concat(get(0), F.lit("-"), _month(get(1)).cast("string"), F.lit("-"), get(2)).try_cast("date")),
            f"{v}z": F.when(F.size(f) == 8, get(7)),
        })
        out = out.withColumns({f"{v}h": _hour(get(3), get(6)), f"{v}m": _int(get(4)), f"{v}sec": F.coalesce(_int(get(5)), F.lit(0))})
        h, m, sec = (F.col(v + x) for x in ("h", "m", "sec"))
        seconds = F.unix_date(f"{v}day").cast("long") * 86400 + h * 3600 + m * 60 + sec
        out = out.withColumns({
            f"{v}local": F.when((h < 24) & (m < 60) & (sec < 60), seconds),
            f"{v}off": F.when(z != "", _written_offset(z, abbreviations)),
            f"{v}name": F.when(z == "", F.coalesce(tz, F.lit("UTC"))).otherwise(z),
        })
        local, off, name = (F.col(v + x) for x in ("local", "off", "name"))
        out = out.withColumn(
            f"{new}__al",
            F.when(s.rlike(r"^[0\W]*$"), F.lit(None).cast("long"))
            .when(s.rlike(r"^[0-9]{10}$"), s.cast("long"))
            .when(s.rlike(r"^[0-9]{13}$"), F.floor(s.cast("long") / 1000).cast("long"))
            .when(off.isNotNull(), local - off)
            .when(name.isin(names), _to_utc(local, name, ambiguous, nonexistent)),
        )
    # The generator keeps later filters on the new columns above the projections;
    # pushed down they would repeat the whole cascade for each mention.
    keep = [c for c in rows.columns if c not in columns.values()]
    values = F.array(F.struct(*[F.col(f"{n}__al").alias(n) for n in columns.values()]))
    return out.select(*[F.col(f"`{c}`") for c in keep], F.inline(values))
