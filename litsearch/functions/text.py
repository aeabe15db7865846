"""Text and key-list columns, all from built-in expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from litsearch.fixed_values import LIST_SEPARATOR, WHITE_SPACE, WORD_SPLIT


def strip_ends(text: Column) -> Column:
    """Cut white space of every kind at both ends (``trim`` knows blanks only).

    Linear in the text, which a pattern for white space at the end is not.
    """
    return F.btrim(text, F.lit(WHITE_SPACE))


def flatten_html(html: Column) -> Column:
    """One line per page: no line ends of any kind, tabs to blanks, ends stripped."""
    return strip_ends(F.translate(html, "\t\n\r", " "))


def words(text: Column) -> Column:
    """Lower-cased words of a text, in order."""
    return F.filter(F.split(F.lower(text), WORD_SPLIT), lambda w: w != "")


def decode_list(text: Column) -> Column:
    """``a;b;`` or ``a;b`` to an array; empty keys dropped, null stays null."""
    return F.filter(F.split(text, LIST_SEPARATOR), lambda k: k != "")


def encode_list(keys: Column, trailing: bool = False) -> Column:
    """Array to ``a;b`` text, or ``a;b;`` when ``trailing``."""
    joined = F.concat_ws(LIST_SEPARATOR, keys)
    if not trailing:
        return joined
    return F.when(F.size(keys) > 0, F.concat(joined, F.lit(LIST_SEPARATOR))).otherwise(joined)


def lower_keys(keys: Column) -> Column:
    """Lower-cased non-empty keys of a key list, repeats kept, null as empty."""
    return F.filter(
        F.transform(F.coalesce(keys, F.array().cast("array<string>")), F.lower),
        lambda k: k != "",
    )


def normalise_topic(key: Column) -> Column:
    """Lower case, one blank at the end cut."""
    return F.regexp_replace(F.lower(key), " $", "")


def doc_key(url: Column) -> Column:
    """Last two parts of a link joined by ``_``."""
    parts = F.split(url, "/")
    return F.concat_ws("_", F.get(parts, F.size(parts) - 2), F.get(parts, F.size(parts) - 1))
