"""Keep computed columns computed once.

Catalyst substitutes a projection's expressions into every filter pushed
below it, and a parser's columns are long expression chains (a split, a
dozen regexes): pushed into three predicates they are evaluated three
times and the generated code outgrows the compiler.  ``fence`` re-emits
the columns from a one-element ``inline`` generator, so anything above it
sees plain attributes.  It is a narrow, code-generated operator: no
shuffle, no materialisation.  Columns named in ``outside`` stay beside the
generator, so that filters on them still reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame, *outside: str) -> DataFrame:
    inside = [F.col(c) for c in df.columns if c not in outside]
    return df.select(*outside, F.inline(F.array(F.struct(*inside))))
