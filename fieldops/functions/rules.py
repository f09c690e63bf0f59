"""Predicates, rule columns, date maths and SLA bands (column -> column).

Every rule is a native expression (``when`` chains, array higher-order
functions), so it stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldops import config


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _true(cond: Column) -> Column:
    """NULL-safe condition: unknown counts as false (as NaN/NaT comparisons do)."""
    return F.coalesce(cond, F.lit(False))


# --------------------------------------------------------------------------- predicates

def icontains(c: Column | str, s: str) -> Column:
    """Case-insensitive substring test; NULL -> false."""
    return _true(F.lower(_col(c)).contains(s.lower()))


def any_marker(c: Column | str, markers: Sequence[str]) -> Column:
    """The text contains one of the markers (case matters); NULL -> false."""
    out = F.lit(False)
    for m in markers:
        out = out | _true(_col(c).contains(m))
    return out


def exclude_values(c: Column | str, values: Iterable[str] = config.EXCLUDED_CANCEL_REASONS) -> Column:
    """Predicate keeping rows whose value is not listed; NULL is kept."""
    return ~_true(_col(c).isin(list(values)))


def eligible_task(task_id: Column | str, category: Column | str) -> Column:
    """Id contains CM, or id contains PLM and category is PROACTIVO."""
    return icontains(task_id, "CM") | (icontains(task_id, "PLM") & _true(_col(category) == "PROACTIVO"))


def supply_task(category: Column | str, status: Column | str) -> Column:
    """P5: category mentions supply and status is not canceled (NULL kept)."""
    return icontains(category, config.SUPPLY_CATEGORY_WORD) & ~_true(_col(status) == config.CANCELED_STATUS)


def vendor(bucket: Column | str, vendors: Sequence[str] = config.VENDORS) -> Column:
    """First vendor named in the bucket (case-insensitive), else ''."""
    b = F.lower(_col(bucket))
    out = F.when(_true(b.contains(vendors[0])), F.lit(vendors[0]))
    for v in vendors[1:]:
        out = out.when(_true(b.contains(v)), F.lit(v))
    return out.otherwise(F.lit(""))


def soft_launch(department: Column | str, province: Column | str,
                dept_value: str = "Puno", prov_value: str = "Cañete") -> Column:
    """P7: 'MB' when the department or the province is the soft-launch one."""
    cond = _true(_col(department) == dept_value) | _true(_col(province) == prov_value)
    return F.when(cond, F.lit(config.L_SOFT_LAUNCH)).otherwise(F.lit(""))


def proactive(notes: Column | str) -> Column:
    """P8: 'Proactivo' when the notes mention it (any case)."""
    return F.when(icontains(notes, config.PROACTIVE_WORD), F.lit(config.L_PROACTIVE)).otherwise(F.lit(""))


def responsible(bucket: Column | str, vendors: Sequence[str] = config.VENDORS) -> Column:
    """P9: 'FLM' when the bucket names a vendor -- case-sensitive, unlike P6."""
    b = _col(bucket)
    cond = F.lit(False)
    for v in vendors:
        cond = cond | _true(b.contains(v))
    return F.when(cond, F.lit(config.L_FLM)).otherwise(F.lit(config.L_TDP))


def status_conflict(order_status: Column | str, task_status: Column | str,
                    rules=config.STATUS_CONFLICT_RULES) -> Column:
    """P10: label for contradictory work-order / first-task statuses."""
    o, t = _col(order_status), _col(task_status)
    out = None
    for ostat, tstats, label in rules:
        cond = _true((o == ostat) & t.isin(tstats))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(""))


def since(c: Column | str, ts: str) -> Column:
    """Predicate c >= ts; NULL is dropped."""
    return _true(_col(c) >= F.lit(ts).cast("timestamp_ntz"))


def in_range_flag(c: Column | str, lo: Column, hi: Column) -> Column:
    """P12: 'en_rango' when lo <= c <= hi (bounds usually scalar subqueries)."""
    return F.when(_true(_col(c).between(lo, hi)), F.lit(config.L_IN_RANGE)).otherwise(F.lit(""))


def yes_no(cond: Column, yes: str = "SI", no: str = "NO") -> Column:
    return F.when(_true(cond), F.lit(yes)).otherwise(F.lit(no))


def ac_fault(specialities: Sequence[Column | str], sub_specialities: Sequence[Column | str]) -> Column:
    """P14: 'Si' when any slot has speciality ENERGIA and an AC sub-speciality."""
    slots = F.array(*[F.struct(_col(s).alias("sp"), _col(u).alias("sub"))
                      for s, u in zip(specialities, sub_specialities)])
    hit = F.exists(slots, lambda x: _true((x["sp"] == config.AC_SPECIALITY)
                                          & F.upper(F.coalesce(x["sub"], F.lit(""))).contains("AC")))
    return yes_no(hit, "Si", "No")


def any_present(*cols: Column | str) -> Column:
    """P15: 'Si' when any of the columns is not NULL."""
    return yes_no(F.coalesce(*[_col(c) for c in cols]).isNotNull(), "Si", "No")


def any_true(*conds: Column) -> Column:
    """P15: 'Si' when any condition holds."""
    acc = F.lit(False)
    for c in conds:
        acc = acc | _true(c)
    return yes_no(acc, "Si", "No")


# --------------------------------------------------------------------------- date maths

def micros_between(start: Column | str, end: Column | str) -> Column:
    """Exact microseconds from start to end (BIGINT); works on TIMESTAMP_NTZ
    without touching the session zone."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Fractional hours from start to end."""
    return micros_between(start, end) / F.lit(3.6e9)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """D3: fractional minutes from start to end."""
    return micros_between(start, end) / F.lit(6.0e7)


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Elapsed days, floored (a negative gap of 2 h is -1)."""
    return F.floor(micros_between(start, end) / F.lit(8.64e10)).cast("bigint")


def days_since(start: Column | str, end: Column | str) -> Column:
    """Whole elapsed days, kept only when > 0 (not calendar days)."""
    d = whole_days(start, end)
    return F.when(d > 0, d)


def open_age_hours(created: Column | str, status: Column | str, as_of: Column,
                   done: Sequence[str] = config.ORDER_DONE_STATUSES) -> Column:
    """Hours open as of ``as_of`` for work orders not done; else NULL."""
    return F.when(~_true(_col(status).isin(list(done))), hours_between(created, as_of))


def age_band(hours: Column | str) -> Column:
    """Green (1e-6..3], yellow (3..6], red > 6, else ''."""
    h = _col(hours)
    return (F.when(_true(h.between(config.AGE_GREEN_MIN, config.AGE_GREEN_MAX)), F.lit("verde"))
            .when(_true((h > config.AGE_GREEN_MAX) & (h <= config.AGE_YELLOW_MAX)), F.lit("amarillo"))
            .when(_true(h > config.AGE_YELLOW_MAX), F.lit("rojo"))
            .otherwise(F.lit("")))


def attention_below(c: Column | str, limit: int = config.ATTENTION_DAYS_BELOW) -> Column:
    """The value truncated to an integer is non-zero and below ``limit``."""
    v = _col(c).cast("double").cast("bigint")
    return _true((v != 0) & (v < limit))


def attention_positive(c: Column | str) -> Column:
    """The value truncated to an integer is > 0."""
    return _true(_col(c).cast("double").cast("bigint") > 0)


def attention_paused(c: Column | str) -> Column:
    """The pause state mentions 'Pause' (case-sensitive)."""
    return _true(_col(c).contains("Pause"))


# --------------------------------------------------------------------------- SLA rules

def target_hours(tier: Column | str, table: Mapping[str, float] = config.TIER_TARGET_HOURS) -> Column:
    """L1: containment target by tier (trimmed), else NULL."""
    t = F.trim(_col(tier))
    out = None
    for k, v in table.items():
        out = F.when(t == k, F.lit(float(v))) if out is None else out.when(t == k, F.lit(float(v)))
    return out


def _band_minutes(target: Column):
    lo = (target + F.lit(config.PERSISTENCE_HOURS - config.TOLERANCE_HOURS)) * F.lit(60.0)
    hi = (target + F.lit(config.PERSISTENCE_HOURS + config.TOLERANCE_HOURS)) * F.lit(60.0)
    return lo, hi


def compliance(target: Column | str, start: Column | str, registered: Column | str) -> Column:
    """L2: containment compliance of the work-order registration time."""
    t, s, r = _col(target), _col(start), _col(registered)
    lo, hi = _band_minutes(t)
    minutes = minutes_between(s, r)
    return (F.when(t.isNull(), F.lit(config.L_SLA_NO_SITE))
            .when(s.isNull() | r.isNull(), F.lit(config.L_SLA_NO_ORDER))
            .when(minutes < lo, F.lit(config.L_SLA_EARLY))
            .when(minutes > hi, F.lit(config.L_SLA_LATE))
            .otherwise(F.lit(config.L_SLA_OK)))


def bounded_min(cols: Sequence[Column | str], limit: float = config.CANCEL_OUTLIER_HOURS) -> Column:
    """Row-wise minimum of the values below ``limit`` (NULLs skipped,
    negatives kept); NULL when none qualifies."""
    return F.array_min(F.filter(F.array(*[_col(c).cast("double") for c in cols]), lambda x: x < limit))


def cancel_outcome(target: Column | str, min_hours: Column | str, hours: Sequence[Column | str]) -> Column:
    """L3: cancellation timing against the containment window."""
    t, m = _col(target), _col(min_hours)
    lo, hi = _band_minutes(t)
    none_cancelled = F.coalesce(*[_col(h) for h in hours]).isNull()
    minutes = m * F.lit(60.0)
    return (F.when(t.isNull(), F.lit(config.L_SLA_NO_SITE))
            .when(m.isNull() & none_cancelled, F.lit(config.L_CANCEL_NONE))
            .when(m.isNull(), F.lit(config.L_CANCEL_OUTLIER))
            .when(minutes < lo, F.lit(config.L_CANCEL_EARLY))
            .when(minutes > hi, F.lit(config.L_CANCEL_LATE))
            .otherwise(F.lit(config.L_CANCEL_OK)))


def cancel_bin(min_hours: Column | str, outcome: Column | str) -> Column:
    """L4: half-open hour bins; the outlier label first; negatives fall to 72+."""
    m, o = _col(min_hours), _col(outcome)
    out = F.when(_true(o == config.L_CANCEL_OUTLIER), F.lit(config.L_CANCEL_OUTLIER)).when(m.isNull(), F.lit(None))
    for lo, hi, label in config.CANCEL_BINS:
        out = out.when((m >= lo) & (m < hi), F.lit(label))
    return out.otherwise(F.lit(config.CANCEL_BIN_REST))


def swap_relation(site: Column | str, start: Column | str, swap_end: Column | str) -> Column:
    """Incident relative to the site's swap end."""
    return (F.when(_col(site).isNull(), F.lit(config.L_SWAP_NO_SITE))
            .when(_true(_col(swap_end).isNotNull() & (_col(start) > _col(swap_end))), F.lit(config.L_SWAP_AFTER))
            .otherwise(F.lit(config.L_SWAP_UNRELATED)))


def no_order_reason(corporate: Column | str, order_id: Column | str, provider: Column | str,
                    site: Column | str, providers: Sequence[str] = config.VENDORS_UPPER) -> Column:
    """Why an incident has no work order.  Corporate case, else has-order /
    not-identified; then a site whose provider is not a contracted vendor
    (NULL provider included) overrides everything except 'has order'."""
    first = (F.when(_true(_col(corporate)), F.lit(config.L_CORPORATE))
             .when(_col(order_id).isNotNull(), F.lit(config.L_HAS_ORDER))
             .otherwise(F.lit(config.L_ORDER_UNKNOWN)))
    other_site = ~_true(_col(provider).isin(list(providers))) & _col(site).isNotNull()
    return F.when(other_site & (first != config.L_HAS_ORDER), F.lit(config.L_OTHER_OPERATOR_SITE)).otherwise(first)
