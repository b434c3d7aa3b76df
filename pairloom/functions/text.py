"""Column functions over record text; all stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that both Java and RE2 classes are told explicitly.
SPACE = r"[\s\x0b\x{00a0}\x{3000}]+"
WORD = r"[\p{L}\p{N}_]"


def normalize_text(c: Column, null_token: str = "") -> Column:
    """Runs of white space become one space, ends are trimmed, null becomes ``null_token``."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit(null_token)), SPACE, " "))


def normalize_key(c: Column, null_token: str = "") -> Column:
    """Lower-cased text in which everything but a-z and 0-9 is one space."""
    return F.trim(F.regexp_replace(F.lower(normalize_text(c, null_token)), "[^a-z0-9]+", " "))


def record_text(fields: list[str], prefix: str = "") -> Column:
    """``COL name VAL value`` of the ``fields`` in order, joined by spaces; nulls are empty values."""
    parts = [F.concat(F.lit(f"COL {f.removeprefix(prefix)} VAL "), normalize_text(F.col(f"`{f}`"))) for f in fields]
    return F.concat_ws(" ", *parts)


def record_text_except(columns: list[str], skip: list[str], strip_only: bool = False) -> Column:
    """Record text of all ``columns`` but ``skip``, compared without case; ``strip_only`` leaves inner white space as it is."""
    left_out = {s.lower() for s in skip}
    kept = [c for c in columns if c.lower() not in left_out]
    if not strip_only:
        return record_text(kept)
    return F.concat_ws(" ", *(F.concat(F.lit(f"COL {c} VAL "), F.trim(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")))) for c in kept))


def tagged_record_text(table: str, id_col: str, fields: list[str]) -> Column:
    """Record text that starts with the source table and the id."""
    return F.concat(F.lit(f"COL table VAL {table} COL id VAL "), normalize_text(F.col(id_col)), F.lit(" "), record_text(fields))


def parse_field(text: Column, field: str) -> Column:
    """The value of ``field`` in a record text, trimmed; empty if there is none."""
    return F.trim(F.regexp_extract(text, rf"COL\s+{field}\s+VAL\s+(.*?)(?=\s+COL\s+|\s*$)", 1))


def char_ngrams(c: Column, n: int, strip: bool = True, short: str = "keep") -> Column:
    """The set of character n-grams, lower-cased. A shorter text is its own gram (``short="drop"``: has none)."""
    t = F.lower(F.coalesce(c, F.lit("")))
    t = F.trim(t) if strip else t
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - (n - 1), F.lit(1))), lambda i: F.substring(t, i, F.lit(n))))
    none = F.expr("cast(array() as array<string>)")
    few = F.when(F.length(t) == 0, none).otherwise(F.array(t)) if short == "keep" else none
    return F.when(F.length(t) < n, few).otherwise(grams)


def word_tokens(c: Column, least: int = 1, distinct: bool = True) -> Column:
    """Lower-cased words of at least ``least`` letters, digits or underscores."""
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"{WORD}{{{least},}}"), F.lit(0))
    return F.array_distinct(found) if distinct else found


def mask_words(text: Column, mask: Column, token: str = "[MASK]") -> Column:
    """Words whose entry in ``mask`` is 0 replaced by ``token``."""
    return F.concat_ws(" ", F.transform(F.split(text, " "), lambda w, i: F.when(F.get(mask, i) == 1, w).otherwise(F.lit(token))))
