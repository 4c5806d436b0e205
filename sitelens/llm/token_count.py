"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a text stand in a linked list; a heap holds the adjacent pairs
that form a piece, lowest rank first and leftmost among equals. Popping the
best pair and joining it until the heap is empty leaves the library's
segmentation. Only its length is kept: initial symbols minus merges, where a
character outside the vocabulary counts its UTF-8 bytes (byte fallback). No
ids are made.

No piece holds a blank after another character, and most pairs of adjacent
characters occur in no piece at all. No merge crosses such a place, so texts
are cut there and the counts of short units are remembered per worker.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import prepare, text_list

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
BLANK = "▁"
UNIT_CHARS = 64          # longer units are counted but not remembered
MEMO_UNITS = 500_000     # remembered units per worker and level


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class _Memo(dict):
    """Counts by unit; the missing ones are computed, a full memo starts anew."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, unit: str) -> int:
        n = self.compute(unit)
        if len(unit) <= UNIT_CHARS:
            if len(self) >= MEMO_UNITS:
                self.clear()
            self[unit] = n
        return n


class Counter:
    """Counts tokens as the model at ``path`` would give them."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        pieces = [(sp.id_to_piece(i), sp.get_score(i)) for i in ids
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        order = sorted(pieces, key=lambda x: -x[1])
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.rank = {p: i for i, (p, _) in enumerate(order) if len(p) > 1}
        self.pairs = {p[i:i + 2] for p in self.rank for i in range(len(p) - 1)}
        if any(pair[1] == BLANK and pair[0] != BLANK for pair in self.pairs):
            raise ValueError("pieces with inner blanks are not supported")
        # characters that join nothing always stand alone
        joined = set("".join(self.pairs))
        self.alone = [c for c in "\n\t\r" if c not in joined]
        stop = re.escape("".join(self.alone))
        self.units = re.compile(f" +[^ {stop}]*|[^ {stop}]+").findall
        self.unit = _Memo(self._split)
        self.part = _Memo(self._merge)

    def cost(self, symbol: str) -> int:
        if symbol in self.single or symbol in self.rank:
            return 1
        return len(symbol.encode("utf-8"))

    def count(self, text: str) -> int:
        """Tokens of a whole text; the empty text has none."""
        if not text:
            return 0
        text = " " + text.replace(BLANK, " ")   # the dummy blank before the first word
        n = sum(map(self.unit.__getitem__, self.units(text)))
        for c in self.alone:
            n += text.count(c) * self.cost(c)
        return n

    def _split(self, unit: str) -> int:
        """Cut a unit between characters that no piece holds side by side."""
        unit = unit.replace(" ", BLANK)
        n, lo, pairs = 0, 0, self.pairs
        for i in range(1, len(unit)):
            if unit[i - 1:i + 1] not in pairs:
                n += self.part[unit[lo:i]]
                lo = i
        return n + self.part[unit[lo:]]

    def _merge(self, s: str) -> int:
        """Initial symbols minus merges."""
        n = len(s)
        single = self.single
        count = sum(1 if c in single else len(c.encode("utf-8")) for c in s)
        if n < 2:
            return count
        rank = self.rank
        heap = []
        for i in range(n - 1):
            r = rank.get(s[i:i + 2])
            if r is not None:
                heap.append((r, i, 2))
        heapify(heap)
        size = [1] * n + [0]
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        while heap:
            _, i, total = heappop(heap)
            if not size[i]:
                continue
            j = after[i]
            if j >= n or size[i] + size[j] != total:
                continue
            if size[i] == 1 and s[i] not in single:
                count -= len(s[i].encode("utf-8")) - 1
            if size[j] == 1 and s[j] not in single:
                count -= len(s[j].encode("utf-8")) - 1
            count -= 1
            size[i], size[j] = total, 0
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank.get(s[i:k + size[k]])
                if r is not None:
                    heappush(heap, (r, i, total + size[k]))
            h = before[i]
            if h >= 0:
                r = rank.get(s[h:k])
                if r is not None:
                    heappush(heap, (r, h, size[h] + total))
        return count


@functools.lru_cache(maxsize=2)
def worker_counter(path: str) -> Counter:
    """The counter of this Python worker; Spark reuses workers, so remembered
    units serve task after task."""
    return Counter(path)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) per input row.

    Whole texts, null and empty count 0 and 0; a null id stays null; other
    columns are not read; repeated rows are counted each. No shuffle."""
    prepare(docs.sparkSession)
    path = path or default_path()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(path)
        for batch in batches:
            texts = text_list(batch.column(1))
            counts = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                 pa.array(counts, pa.int64()), pa.array([n > limit for n in counts])],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
