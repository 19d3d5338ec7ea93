"""ZIP files made from table rows, as input of the archive queries."""

from __future__ import annotations

import io
import sys
import zipfile

from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

cloudpickle.register_pickle_by_value(sys.modules[__name__])


# By rows: Spark hands such a function some hundred rows at a time, however long their texts.
@F.udf(BinaryType(), useArrow=False)
def pack(a: str, x: str, b: str, y: str) -> bytes:
    """One archive of two members per row."""
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as bundle:
        bundle.writestr(a, x)
        bundle.writestr(b, y)
    return blob.getvalue()
