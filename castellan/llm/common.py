"""What several of the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but these six ASCII blanks.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a whole text, in order; of a null text none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def let(value: Column, body) -> Column:
    """body(value) with value computed once: Catalyst would paste a projected expression into a lambda and evaluate it there per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with its columns renamed by position, and the new name of each: columns that an operator adds then clash with none."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names
