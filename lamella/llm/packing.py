"""Best-fit packing of tokenised documents into sequences, improved by swap-based local search.

Texts are tokenised where they are read and leave as one small row a piece. Pieces are dealt by hash into
groups of about GROUP, each packed in one task: best fit decreasing, then local search that moves pieces
between underfull sequences, or exchanges one for one or two for one, wherever that raises the sum of squared
fills, until sequences empty. The pieces of sequences that stay underfull are dealt anew, into fewer groups,
and packed again, until they fit one group. Every round writes its rows to the shared folder.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stored

CAPACITY = 1024
END = 2  # id that ends a document (fixed by the contract)
GROUP = 1 << 15
#: Underfull sequences that a local search looks at, at a time.
WINDOW = 96

_encoders: dict[str, object] = {}


def encoder(name: str):
    """The byte-level BPE of the tokenizer file `name`.json, read from its equal rank file, which encodes several times as fast."""
    if name not in _encoders:
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken")) as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        special = {"<|endoftext|>": len(ranks)}
        _encoders[name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _encoders[name]


def token_ids(text: str, name: str) -> np.ndarray:
    """The ids that the tokenizer file gives, and END."""
    coder = encoder(name)
    ids = coder.encode(text, allowed_special="all") if "<|endoftext|>" in text else coder.encode_ordinary(text)
    return np.array([*ids, END], "<u4")


def _pieces(name: str, capacity: int):
    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = token_ids(text or "", name)
                    first = (len(ids) - 1) % capacity + 1 if len(ids) > capacity else len(ids)
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    rows += [(doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                doc, piece, start, length, crc = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Best fit decreasing: bins of item numbers. Bins are found by their free space, a bit set of the spaces in use."""
    order = np.argsort(-sizes, kind="stable")
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = 0  # bit s: a bin has s free
    bins: list[list[int]] = []
    for item in order.tolist():
        size = int(sizes[item])
        fit = spaces >> size
        if size and fit:
            space = size + (fit & -fit).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                spaces &= ~(1 << space)
        else:
            space, b = capacity, len(bins)
            bins.append([])
        bins[b].append(item)
        left = space - size
        if left:
            by_space[left].append(b)
            spaces |= 1 << left
    return bins


def local_search(bins: list[list[int]], sizes: np.ndarray, capacity: int = CAPACITY, window: int = WINDOW) -> list[list[int]]:
    """Moves and exchanges between underfull bins that raise the sum of squared fills; empty bins are dropped.

    Underfull bins are taken `window` at a time, emptiest first. Between a fuller bin a and an emptier b, a gains
    d if an item of d moves from b to a, if one of b is exchanged for one of a smaller by d, or one of b for two
    of a smaller together by d. Any d of 1 up to a's free space raises the sum; the largest is taken.
    """
    size = sizes.tolist()
    fills = [sum(size[i] for i in b) for b in bins]
    under = sorted((k for k in range(len(bins)) if fills[k] < capacity), key=lambda k: fills[k])
    for low in range(0, len(under), window):
        open_ = under[low : low + window]
        changed = True
        while changed and len(open_) > 1:
            changed = False
            open_.sort(key=lambda k: -fills[k])
            for n, a in enumerate(open_):
                if not bins[a]:
                    continue
                for b in reversed(open_[n + 1 :]):
                    space = capacity - fills[a]
                    if not space:
                        break
                    best = _exchange(bins[a], bins[b], size, space) if bins[b] and fills[a] >= fills[b] else None
                    if best:
                        gain, out, back = best
                        for i in out:
                            bins[a].remove(i)
                            bins[b].append(i)
                        bins[b].remove(back)
                        bins[a].append(back)
                        fills[a] += gain
                        fills[b] -= gain
                        changed = True
            open_ = [k for k in open_ if 0 < fills[k] < capacity]
    return [b for b in bins if b]


def _exchange(a: list[int], b: list[int], size: list[int], space: int) -> tuple[int, tuple[int, ...], int] | None:
    """(gain of a, items from a, item from b) of the largest gain up to space."""
    out: dict[int, tuple[int, ...]] = {0: ()}
    for i in a:
        out.setdefault(size[i], (i,))
    for n, i in enumerate(a):
        for j in a[:n]:
            out.setdefault(size[i] + size[j], (i, j))
    best = None
    for back in b:
        for total, items in out.items():
            gain = size[back] - total
            if 0 < gain <= space and (best is None or gain > best[0]):
                best = (gain, items, back)
    return best


def _packed(capacity: int, group_bits: int, level: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "start", "ids_crc32"], ascending=[False, True, True, True, True], kind="stable").reset_index(drop=True)
        sizes = pdf["length"].to_numpy()
        bins = local_search(best_fit(sizes, capacity), sizes, capacity)
        number, offset, full = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64), np.empty(len(pdf), bool)
        for k, b in enumerate(bins):
            at = np.cumsum([0, *sizes[b]])
            number[b], offset[b], full[b] = k, at[:-1], at[-1] == capacity
        pdf["sequence_id"] = ((level << 56) | (int(key[0]) << group_bits)) + number
        return pdf.assign(offset=offset, full=full)

    return run


def packed(docs: DataFrame, tokenizer: str = "byte_bpe_50k", capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of each piece of docs(doc_id, text).

    A document is its ids and END; a null text is empty and so has END alone. Longer documents are cut into
    capacity-token pieces, the first of which takes the remainder. Repeated rows are packed as often as they stand.
    An empty table gives no rows; extra columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rest = stored(docs.mapInArrow(_pieces(tokenizer, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    fields = rest.columns
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, grp long, sequence_id long, offset long, full boolean"
    done, before = None, None
    for level in range(24):
        n = rest.count()
        if not n and done is not None:
            break
        # Dealt anew while that shrinks what is left by a tenth at least; then this round's sequences stand.
        groups = max(1, -(-n // group))
        last = groups == 1 or level == 23 or (before is not None and n > 0.9 * before)
        before = n
        dealt = rest.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(level)), F.lit(groups)))
        bins = stored(dealt.groupBy("grp").applyInPandas(_packed(capacity, 20, level), schema), "bins")
        part = bins if last else bins.where("full")
        done = part if done is None else done.unionByName(part)
        if last:
            break
        rest = bins.where("not full").select(*fields)
    return done.drop("grp", "full")
