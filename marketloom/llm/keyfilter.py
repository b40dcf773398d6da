"""A fixed-size bitmap of key hashes that keeps most rows without a partner out of a shuffle.

The bitmap has at most ``BITS`` bits at any scale, fewer for few keys, so what reaches the driver and the tasks has a proven bound. It only ever lets too many
rows through, never too few: with very many keys it fills up and the join behind it shuffles as it would have without.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25
PAGE = 1 << 15
BITS_PER_KEY = 128


def key_bitmap(keys: DataFrame, key: str, bits: int = BITS) -> np.ndarray:
    """Bits set at the place of each 64-bit hash in the column ``key``: ``BITS_PER_KEY`` bits for each key, up to ``bits``."""
    bits = min(bits, max(PAGE, 1 << (BITS_PER_KEY * keys.count()).bit_length()))
    place = F.pmod(F.col(key), F.lit(bits))
    pages = (
        keys.select(key)
        .groupBy(F.shiftright(place, 15).alias("page"))
        .agg(F.bitmap_construct_agg((place % PAGE).cast("long")).alias("bits"))
        .collect()  # at most bits / 8 bytes
    )
    bitmap = np.zeros((bits // PAGE, PAGE // 8), np.uint8)
    for page in pages:
        bitmap[page["page"]] = np.frombuffer(bytes(page["bits"]), np.uint8)
    return bitmap.reshape(-1)


def maybe_set(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.mod(keys, len(bitmap) * 8)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def maybe_among(rows: DataFrame, key: str, keys: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows whose ``key``, a 64-bit hash, may be among the column of the same name of ``keys``."""
    shared = rows.sparkSession.sparkContext.broadcast(key_bitmap(keys, key, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe_set(shared.value, batch.column(key).to_numpy(zero_copy_only=False).astype(np.int64))))

    return rows.mapInArrow(run, rows.schema)
