"""Packing into sequences of a fixed length (operator 5).

The pieces are only known to the driver as a histogram of lengths (at most
``capacity`` numbers, whatever the input).  A configuration is a multiset of
lengths that fits one sequence.  The linear program over configurations is
solved by multiplicative weights: a length's weight falls as it is covered,
knapsack dynamic programming over the weights prices the best configuration
for every length, and what a round adds is rounded down at the end.  The
rounded rest is priced again, and what is left at last is placed best-fit
decreasing, also on the histogram.  The plan has a bounded number of
configurations, each with how often it is used.

Defined results: a null text is an empty text (only the end id); an empty
table gives no rows; repeated rows are packed each for itself; a null id is
carried; a very long text is cut into pieces of ``capacity`` ids, the last may
be shorter; columns other than the id and the text are ignored."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TOKEN_PIECES, free_name, gapless, identified, map_arrow, narrowed, slices, written
from .encode import ENCODE_BYTES, word_encoder

#: Rounds of multiplicative weights, batches of lengths priced in a round, and
#: how often the rounded rest is priced again.
ROUNDS, BATCHES, REPEATS = 12, 16, 4
#: Configurations that leave more than this part of a sequence empty are not
#: rounded but priced again with the rest.
SLACK = 1 / 512


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids): the token ids of each row and an end
    id, cut only where they exceed ``capacity``; ids as int32 binary."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        encode = word_encoder(tokenizer_file)
        for b in slices(batches, text_col, ENCODE_BYTES):
            ids, n = encode(b.column(1))
            per = n + 1
            ends = np.cumsum(per)
            out = np.full(int(ends[-1]), end_id, np.int32)
            body = np.ones(len(out), bool)
            body[ends - 1] = False
            out[body] = ids
            k = -(-per // capacity)
            piece = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            start = piece * capacity
            length = np.minimum(np.repeat(per, k) - start, capacity)
            offsets = np.concatenate(([0], np.cumsum(length) * 4)).astype(np.int32)
            data = pa.BinaryArray.from_buffers(pa.binary(), len(length),
                                               [None, pa.py_buffer(offsets), pa.py_buffer(out)])
            row = pa.array(np.repeat(np.arange(b.num_rows), k))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(row), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), data], ["id", "piece", "start", "length", "ids"])

    kind = dict(docs.dtypes)[id_col]
    return map_arrow(narrowed(docs, id_col, text_col), run,
                     f"id {kind}, piece int, start long, length long, ids binary", keeps=TOKEN_PIECES)


def best_configurations(lengths, values, capacity: int):
    """Knapsack over the capacities 0..capacity with any number of each
    length: (best value of each capacity, index of the length to take there,
    -1 for none)."""
    import numpy as np

    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        if m := fits[c]:
            got = best[c - lengths[:m]] + values[:m]
            k = int(got.argmax())
            if got[k] > best[c - 1]:
                best[c], take[c] = got[k], k
                continue
        best[c], take[c] = best[c - 1], -2 if c > 1 and take[c - 1] != -1 else -1
    return best, take


def _filled(take, lengths, room: int) -> list[int]:
    """Indices of the lengths that fill ``room`` best."""
    out = []
    while room > 0 and take[room] != -1:
        if take[room] == -2:
            room -= 1
        else:
            out.append(int(take[room]))
            room -= int(lengths[take[room]])
    return out


def linear_program(lengths, demand, capacity: int) -> dict[tuple[int, ...], float]:
    """Configurations (sorted indices into ``lengths``) and how often the
    fractional solution uses each, by multiplicative weights."""
    import numpy as np

    used: dict[tuple[int, ...], float] = {}
    covered = np.zeros(len(lengths))
    size = lengths / capacity
    for r in range(1, ROUNDS + 1):
        for batch in range(BATCHES):
            # Long lengths first: they choose what short ones fill.
            short = np.flatnonzero(covered < r / ROUNDS)[::-1]
            if not len(short):
                break
            part = short[:max(1, len(short) // (BATCHES - batch))]
            values = size * np.exp(-4 * np.maximum(0, covered - r / ROUNDS) * ROUNDS)
            _, take = best_configurations(lengths, values, capacity)
            for k in part:
                need = (r / ROUNDS - covered[k]) * demand[k]
                if need <= 0:
                    continue
                config = tuple(sorted([int(k), *_filled(take, lengths, capacity - int(lengths[k]))]))
                kinds, times = np.unique(config, return_counts=True)
                step = min(need / times[kinds == k][0], float((demand[kinds] / times).min()) / ROUNDS)
                used[config] = used.get(config, 0) + step
                covered[kinds] += step * times / demand[kinds]
    return used


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(configuration as lengths, how many sequences have it); the counts of
    the lengths come out exactly."""
    import numpy as np

    left = {n: c for n, c in histogram.items() if c}
    out: list[tuple[tuple[int, ...], int]] = []
    if whole := left.pop(capacity, 0):
        out.append(((capacity,), whole))
    for _ in range(REPEATS):
        if not left:
            break
        lengths = np.array(sorted(left))
        demand = np.array([left[int(n)] for n in lengths], float)
        found = linear_program(lengths, demand, capacity)
        fill = {c: sum(int(lengths[k]) for k in c) for c in found}
        tight = [c for c in found if fill[c] >= capacity * (1 - SLACK)]
        for config in sorted(tight, key=lambda c: (-fill[c], -found[c], c)):
            sizes = [int(lengths[k]) for k in config]
            need = {n: sizes.count(n) for n in sizes}
            times = min([int(found[config] + 0.5), *(left.get(n, 0) // m for n, m in need.items())])
            if times > 0:
                out.append((tuple(sizes), times))
                for n, m in need.items():
                    left[n] -= m * times
        left = {n: c for n, c in left.items() if c}
    return out + best_fit(left, capacity)


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: equal sequences are one entry, so
    the work does not depend on the counts."""
    by_room: dict[int, list[list]] = {}
    for n in sorted(histogram, reverse=True):
        todo = histogram[n]
        while todo:
            room = min((r for r in by_room if r >= n and by_room[r]), default=None)
            if room is None:
                per = min(capacity // n, todo)
                times, rest = divmod(todo, per)
                by_room.setdefault(capacity - per * n, []).append([(n,) * per, times])
                todo = rest
                if rest:
                    by_room.setdefault(capacity - rest * n, []).append([(n,) * rest, 1])
                    todo = 0
                continue
            entry = by_room[room][-1]
            per = min(room // n, todo)
            times = min(entry[1], todo // per)
            if times == entry[1]:
                by_room[room].pop()
            else:
                entry[1] -= times
            by_room.setdefault(room - per * n, []).append([entry[0] + (n,) * per, times])
            todo -= per * times
    return [(tuple(c), t) for entries in by_room.values() for c, t in entries]


def _runs(made: list[tuple[tuple[int, ...], int]]):
    """The plan as runs, sorted by length and first rank: of a length, the
    pieces of rank first.. go ``per`` to a sequence from number ``seq`` on, at
    ``offset``."""
    import numpy as np

    seen: dict[int, int] = {}
    rows, seq = [], 0
    for config, times in made:
        offset = 0
        for n in sorted(set(config)):
            per = config.count(n)
            rows.append((n, seen.get(n, 0), per, seq, offset))
            seen[n] = seen.get(n, 0) + per * times
            offset += per * n
        seq += times
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5)


def pack(parts: DataFrame, rows: int, capacity: int = 2048) -> DataFrame:
    """Adds (sequence_id, offset) to ``parts`` (id, piece, length, ...), a
    table of ``rows`` rows; the histogram has at most ``capacity`` entries."""
    histogram = {r["length"]: r["n"] for r in
                 parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = _runs(plan(histogram, capacity))
    # Rows of one length are dealt by their place in the table: ids may be null or repeat.
    place, rank_col = free_name(parts, "_place"), free_name(parts, "_rank")
    ranked = gapless(identified(parts, place), "length", [F.col(place)], rank_col, rows, salt=[F.col(place)]).drop(place)
    names = [c for c in ranked.columns if c != rank_col]
    at = ranked.columns.index("length"), ranked.columns.index(rank_col)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        # Lengths and ranks as one ascending key.
        step = np.int64(runs[:, 1].max(initial=0) + 1)
        firsts = runs[:, 0] * step + runs[:, 1]
        for b in batches:
            n, rank = (b.column(k).to_numpy(zero_copy_only=False) for k in at)
            low = np.searchsorted(runs[:, 0], n, "left")
            high = np.searchsorted(runs[:, 0], n, "right")
            k = np.minimum(np.searchsorted(firsts, n * step + np.minimum(rank, step - 1), "right"), high) - 1
            k = np.maximum(k, low)
            _, first, per, seq, offset = runs[k].T
            place = rank - first
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in names), pa.array(seq + place // per, pa.int64()),
                 pa.array(offset + place % per * n, pa.int64())], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in ranked.dtypes if c != rank_col)
    return map_arrow(ranked, run, f"{schema}, sequence_id long, offset long")


def packed_digests(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    parts = written(pieces(docs, tokenizer_file, capacity, end_id)
                    .withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return pack(parts, parts.count(), capacity).select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from .common import table
    return packed_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
