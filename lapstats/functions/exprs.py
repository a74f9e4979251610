"""Column expressions (JVM-side, codegen friendly). No Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapstats.schema import COMPOUNDS, SC_CODES, TRACK_STATUS

# "[N days ]HH:MM:SS[.ffffff]" -- the text form of a duration.
_TD_RE = r"^\s*(?:(-?\d+)\s+days?\s*,?\s*)?(\d+):(\d{1,2}):(\d{1,2}(?:\.\d+)?)\s*$"


def duration_text_to_seconds(c: Column | str) -> Column:
    """Duration text -> float seconds; unparseable text -> NULL.

    The reference converts per race file: a file whose column is numeric is
    left alone, a text column is parsed as durations. One scan over many race
    files merges their column types, so a plain number arriving as text is
    taken as seconds (what its own file's numeric column would have been).
    """
    s = F.col(c) if isinstance(c, str) else c
    m = F.regexp_like(s, F.lit(_TD_RE))
    days = F.coalesce(F.regexp_extract(s, _TD_RE, 1).try_cast("double"), F.lit(0.0))
    hours = F.regexp_extract(s, _TD_RE, 2).try_cast("double")
    mins = F.regexp_extract(s, _TD_RE, 3).try_cast("double")
    secs = F.regexp_extract(s, _TD_RE, 4).try_cast("double")
    return F.when(m, days * 86400.0 + hours * 3600.0 + mins * 60.0 + secs).otherwise(s.try_cast("double"))


def format_laptime(c: Column | str) -> Column:
    """Seconds -> 'M:SS.mmm'; NULL -> 'N/A' (F6)."""
    x = F.col(c) if isinstance(c, str) else c
    mins = F.floor(x / 60.0)
    return F.coalesce(F.format_string("%d:%06.3f", mins, x - mins * 60.0), F.lit("N/A"))


def slug(c: Column | str) -> Column:
    """'Great Britain' -> 'great_britain' (F1)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.regexp_replace(F.lower(x), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def slug_to_title(c: Column | str) -> Column:
    """'great_britain' -> 'Great Britain' (F2)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.initcap(F.replace(x, F.lit("_"), F.lit(" ")))


def is_sc_status(status: Column) -> Column:
    """Status text contains a safety-car code; composite codes such as '124' match."""
    return F.coalesce(status.rlike(SC_CODES), F.lit(False))


def decode_status(status: Column) -> Column:
    """Exact-match status label; composites and NULL -> 'Unknown' (P6)."""
    m = F.create_map(*[F.lit(x) for kv in TRACK_STATUS.items() for x in kv])
    return F.coalesce(m[status], F.lit("Unknown"))


def standard_compound(c: Column) -> Column:
    """Upper-case + trim; not a known compound (or NULL) -> 'UNKNOWN' (P9)."""
    u = F.upper(F.trim(c))
    return F.when(u.isin(*COMPOUNDS), u).otherwise(F.lit("UNKNOWN"))


def clean_mask(pit: bool = True, sc: bool = True, outlier: bool = True) -> Column:
    """Predicate for the four clean-lap variants (P12): exclude the flagged lap kinds."""
    cond = F.lit(True)
    if pit:
        cond = cond & ~F.col("is_pit_lap")
    if sc:
        cond = cond & ~F.col("is_sc_lap")
    if outlier:
        cond = cond & ~F.col("is_outlier")
    return cond


def std0(c: Column | str) -> Column:
    """Sample std with n<=1 -> 0 (pandas std().fillna(0))."""
    return F.coalesce(F.stddev_samp(c), F.lit(0.0))


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson r over pairs where both are present; constant side -> NULL.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI mode on a constant column, so the
    ratio is formed with ``try_divide``. A spread below 1e-9 of the mean is
    float noise of a constant and is treated as constant too.
    """
    xc = F.col(x) if isinstance(x, str) else x
    yc = F.col(y) if isinstance(y, str) else y
    both = xc.isNotNull() & yc.isNotNull()
    xs = F.when(both, xc)
    ys = F.when(both, yc)
    sx, sy = F.stddev_samp(xs), F.stddev_samp(ys)
    const = (sx <= F.abs(F.avg(xs)) * 1e-9) | (sy <= F.abs(F.avg(ys)) * 1e-9)
    r = F.try_divide(F.covar_samp(xs, ys), sx * sy)
    return F.when(~const, F.least(F.lit(1.0), F.greatest(F.lit(-1.0), r)))


def r6(c: Column | str, nd: int = 6) -> Column:
    """Round a double for result comparison (only at the output edge)."""
    return F.round(F.col(c) if isinstance(c, str) else c, nd)
