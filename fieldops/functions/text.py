"""Text rules on free-text notes and summaries (column -> column).

Patterns live in ``config``; detector patterns carry ``(?U)`` so Java's ``\\w``
and ``\\b`` treat accented letters as word characters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldops import config
from fieldops.functions.clean import strip


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ac_failure(alarm: Column | str) -> Column:
    """AC-failure rule: the text has 'ac' and a failure word (plain substrings)."""
    a = _col(alarm)
    failure = F.lit(False)
    for w in config.AC_WORDS:
        failure = failure | a.contains(w)
    return F.coalesce(a.contains("ac") & failure, F.lit(False))


def alarm_segment(summary: Column | str) -> Column:
    """First non-empty segment after a '|', lowercased, NOT trimmed."""
    return F.lower(F.nullif(F.regexp_extract(_col(summary), config.RX_ALARM_SEGMENT, 1), F.lit("")))


def alarm_in_notes(notes: Column | str) -> Column:
    """Text after 'Alarma: ' up to the line break (NULL when absent)."""
    return F.nullif(F.regexp_extract(_col(notes), config.RX_ALARM_IN_NOTES, 1), F.lit(""))


def alarm_catalogue(df: DataFrame, alarm: str = "Alarma", kind: str = "Tipo") -> DataFrame:
    """Normalise an alarm catalogue: lower + trimmed alarm, its type."""
    return df.select(F.lower(strip(F.col(alarm))).alias("_alarm_key"), F.col(kind).alias("Tipo"))


def identify_alarms(df: DataFrame, summary: str, notes: str, catalogue: DataFrame) -> DataFrame:
    """Adds ``Alarma`` and ``Tipo``.

    The summary segment is accepted only when it is in the catalogue (compared
    untrimmed against trimmed entries) or matches the AC rule; otherwise the
    notes fallback is used.  The catalogue is de-duplicated by alarm so the
    lookup cannot fan out; AQE broadcasts it when its measured size is small
    (no hint: its size is data-dependent)."""
    cat = catalogue.groupBy("_alarm_key").agg(F.min("Tipo").alias("Tipo"))
    seg = alarm_segment(summary)
    with_seg = df.withColumn("_seg", seg)
    known = cat.select(F.col("_alarm_key").alias("_seg_key"), F.lit(True).alias("_seg_known"))
    x = with_seg.join(known, F.col("_seg") == F.col("_seg_key"), "left")
    accepted = F.when(F.coalesce(F.col("_seg_known"), F.lit(False)) | ac_failure(F.col("_seg")), F.col("_seg"))
    alarm = F.coalesce(strip(F.lower(F.coalesce(accepted, alarm_in_notes(notes)))), F.lit(""))
    x = x.withColumn("Alarma", alarm).drop("_seg", "_seg_key", "_seg_known")
    x = x.join(cat, F.col("Alarma") == F.col("_alarm_key"), "left").drop("_alarm_key")
    tipo = (F.when(F.col("Alarma") == "", F.lit(config.L_ALARM_UNKNOWN))
            .when(ac_failure(F.col("Alarma")), F.lit(config.L_AC_TYPE))
            .when(F.col("Tipo").isNull(), F.lit(config.L_TYPE_UNKNOWN))
            .otherwise(F.col("Tipo")))
    return (x.withColumn("Tipo", tipo)
            .withColumn("Alarma", F.when(F.col("Alarma") == "", F.lit(config.L_ALARM_UNKNOWN)).otherwise(F.col("Alarma"))))


def site_codes(notes: Column | str) -> Column:
    """Distinct site codes in text order (empty array for NULL notes)."""
    found = F.regexp_extract_all(F.coalesce(_col(notes), F.lit("")), F.lit(config.RX_SITE_CODE), 1)
    return F.array_distinct(found)


def corporate_case(notes: Column | str) -> Column:
    """T5: notes look like a corporate circuit case."""
    return F.coalesce(_col(notes).rlike(config.RX_CORPORATE), F.lit(False))


def order_in_notes(notes: Column | str, digits: tuple[int, int] = config.ORDER_DIGITS) -> Column:
    """First order number (least and greatest count of ``digits``; 8 in the
    reference's feed) after 'TOA:'/'SIOM:' (any case) on that line, else the
    'not in notes' label."""
    line = strip(F.regexp_extract(_col(notes), config.RX_ORDER_IN_NOTES, 1))
    number = F.nullif(F.regexp_extract(line, r"(\d{%d,%d})" % digits, 1), F.lit(""))
    return F.coalesce(number, F.lit(config.L_NO_ORDER_IN_NOTES))


def detect(text: Column | str, negation: str | None, verb: str, noun: str, noun_literal: str | None = None) -> Column:
    """T7-T10: 'SI' when the lowercased text is not negated, has an action verb
    and names the equipment; 'NO' otherwise (and for NULL/empty text).
    ``noun_literal`` (a substring every noun match contains) is tested first:
    a byte search that spares the regex scans of long texts that cannot match."""
    t = F.lower(_col(text))
    cond = t.rlike(noun) & t.rlike(verb)
    if noun_literal:
        cond = t.contains(noun_literal) & cond
    if negation is not None:
        cond = cond & ~t.rlike(negation)
    return F.when(F.coalesce(_col(text), F.lit("")) == "", F.lit("NO")).when(cond, F.lit("SI")).otherwise(F.lit("NO"))


def detector(name: str, text: Column | str) -> Column:
    neg, verb, noun = config.DETECTORS[name]
    return detect(text, neg, verb, noun, config.DETECTOR_NOUN_LITERAL.get(name))


def combined_text(cols: Sequence[Column | str], sep: str = ". ") -> Column:
    """The columns joined with '. ', NULL as ''."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])
