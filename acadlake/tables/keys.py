"""When a record has a key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.operators import relational as J


def key_is_whole(schema: T.StructType, keys: list[str], zero_is_blank: bool = False) -> Column:
    """Every key column is present: not NULL and not blank; with ``zero_is_blank`` the number 0 is no key either."""
    numeric = {f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)}

    def given(k: str) -> Column:
        if k in numeric:
            return F.col(k).isNotNull() & (F.col(k) != 0) if zero_is_blank else F.col(k).isNotNull()
        return F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != "")

    return J.conj(given(k) for k in keys)
