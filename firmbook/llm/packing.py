"""Best-fit packing of texts into sequences of several permitted lengths.

A text's length is its number of words; a text longer than the longest
sequence is cut in pieces. Pieces are dealt by hash into groups of bounded
size, and each group is packed by itself, longest piece first: a piece goes to
the open sequence with the least sufficient room. If none has room, a sequence
of the least-cost permitted length is opened, by cost for each word that the
group can still fill it with. At last each sequence shrinks to the smallest
permitted length that holds its contents. A group wastes no more than its last
few sequences, so the loss does not grow with the number of rows in a group.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LENGTHS = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence besides its words.
SEQUENCE_COST = 32
GROUP_PIECES = 20_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def best_fit(sizes: np.ndarray, lengths: tuple, cost: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Sequence number and offset of each piece, and the shrunk length of each sequence.

    sizes: descending, all between 1 and the largest permitted length.
    """
    lengths = sorted(lengths)
    behind = np.append(np.cumsum(sizes[::-1])[::-1], 0)  # words from a piece on
    rising = sizes[::-1]
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    rooms, by_room, filled, opened = [], {}, [], []
    for i, size in enumerate(sizes.tolist()):
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            number = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
        else:
            best = None
            for length in lengths:
                if length >= size:
                    fitting = len(sizes) - np.searchsorted(rising, length - size, side="right")
                    words = min(length, size + behind[max(i + 1, fitting)])
                    price = (length + cost) / words
                    if best is None or price <= best[0]:
                        best = price, length
            room, number = best[1], len(filled)
            filled.append(0)
            opened.append(best[1])
        sequence[i], offset[i] = number, filled[number]
        filled[number] += size
        room -= size
        if room:
            if room not in by_room:
                by_room[room] = []
                insort(rooms, room)
            by_room[room].append(number)
    return sequence, offset, [lengths[bisect_left(lengths, n)] for n in filled]


def pack(
    docs: DataFrame,
    lengths: tuple = LENGTHS,
    cost: int = SEQUENCE_COST,
    group_pieces: int = GROUP_PIECES,
    length: Column | None = None,
) -> DataFrame:
    """doc_id, piece, start, n_words, sequence_id, capacity, position of every piece of every text.

    start and n_words: the piece's words within the text, counted from 0;
    position: its first place in the sequence. Null and empty texts have no
    piece and no row. Rows with null or equal ids are packed one by one.
    `length` may name another measure of a text, as tokens. Columns other than
    doc_id and text are not looked at.
    """
    if not lengths or min(lengths) < 1:
        raise ValueError("sequence lengths are positive")
    longest = max(lengths)
    sizes = docs.select("doc_id", (word_count() if length is None else length).cast("long").alias("words")).where("words > 0")
    total = sizes.agg(F.sum(F.ceil(F.col("words") / longest)).alias("pieces")).first()["pieces"] or 0
    groups = int(total) // group_pieces + 1
    pieces = sizes.select(
        "doc_id", "words", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("words") - 1) / longest))).alias("piece")
    ).select(
        # The place among its own partition keeps equal rows from one group.
        F.pmod(F.xxhash64("doc_id", "piece", F.spark_partition_id()), F.lit(groups)).alias("group"),
        "doc_id",
        "piece",
        (F.col("piece") * longest).alias("start"),
        F.least(F.lit(longest), F.col("words") - F.col("piece") * longest).alias("n_words"),
    )

    def one_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_words", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        sequence, position, shrunk = best_fit(rows["n_words"].to_numpy(), lengths, cost)
        out = rows[["doc_id", "piece", "start", "n_words"]].astype({"doc_id": "Int64"})
        out["sequence_id"] = (rows["group"].to_numpy() << 32) + sequence
        out["capacity"] = np.array(shrunk, np.int64)[sequence]
        out["position"] = position
        return out

    schema = "doc_id long, piece long, start long, n_words long, sequence_id long, capacity long, position long"
    return pieces.groupBy("group").applyInPandas(one_group, schema)
