"""Cost-balanced packing of whole documents into token sequences.

Documents are tokenised in their scan task. A task packs its own documents
group by group, a group being ``GROUP_TOKENS`` tokens or more, so nothing is
shuffled, memory is bounded and no group grows with the input. In a group, full
``capacity`` pieces of long documents are sequences of their own. The rest are
taken in descending order of length and each goes to the sequence of lowest
cost (linear plus quadratic attention cost of its pieces) that has room.
Documents that fit nowhere whole are cut over the room that is left. What
remains of a group fills sequences of power-of-two lengths, which need no
padding.

Defined results: NULL and empty texts are the end-of-document id alone;
repeated rows are packed each; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import byte_list, keyed, original_id, small_batches

CAPACITY = 4096
GROUP_TOKENS = 1 << 20
#: Cost of a piece of n tokens: n + n * n / QUADRATIC (attention costs as much as the rest at n = QUADRATIC).
QUADRATIC = 2048
#: Entries after which a worker's token caches start anew.
CACHE_ENTRIES = 600_000


class CachedTokenizer:
    """Ids of whole texts; each blank-separated chunk is tokenised once per worker.

    Valid for tokenizers that never join characters across white space. Chunks
    of plain letters and closing punctuation are split here and their parts
    given to the BPE model; all other chunks go through the whole tokenizer.
    """

    _CHUNK = re.compile(r"([a-zß-öø-ÿ]+)([^\w\s']+)?")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.chunks: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level alphabet: other bytes follow from 256 on
        others = [b for b in range(256) if b not in visible]
        self.alphabet = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(others)}

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            shown = part.encode().decode("latin-1").translate(self.alphabet)
            ids = self.parts[part] = np.array([t.id for t in self.whole.model.tokenize(shown)], "<u4").tobytes()
        return ids

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        m = self._CHUNK.fullmatch(text.lower()) if "Σ" not in text and unicodedata.is_normalized("NFC", text) else None
        # what Python's tables don't know yet may be a letter in the tokenizer's
        if m and (text.isascii() or all(unicodedata.category(c) != "Cn" for c in text)):
            ids = self._part(m[1]) + (self._part(m[2]) if m[2] else b"")
        else:
            ids = np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return ids

    def encode(self, text: bytes) -> bytes:
        """Little-endian 32-bit ids."""
        chunks = text.split()
        known = self.chunks
        if len(known) > CACHE_ENTRIES:
            known.clear()
        if len(self.parts) > CACHE_ENTRIES:
            self.parts.clear()
        out = list(map(known.get, chunks))
        if None in out:
            for i, ids in enumerate(out):
                if ids is None:
                    c = chunks[i]
                    ids = known.get(c)
                    if ids is None:
                        ids = known[c] = self._chunk(c)
                    out[i] = ids
        return b"".join(out)


def pack_group(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)``; every sequence is full or a power of two long."""
    pieces, rest, sequences = [], [], 0
    for d, n in enumerate(lengths):
        full = n // capacity
        for k in range(full):
            pieces.append((d, k * capacity, capacity, sequences, 0))
            sequences += 1
        if n % capacity:
            rest.append((n % capacity, d, full * capacity))
    rest.sort(key=lambda r: (-r[0], r[1]))
    bins = sum(r[0] for r in rest) // capacity
    used, queue = [0] * bins, [(0.0, i) for i in range(bins)]
    uncut = []
    smallest = rest[-1][0] if rest else 0
    for n, d, start in rest:
        passed = []
        while queue:
            cost, i = heapq.heappop(queue)
            if used[i] + n <= capacity:
                pieces.append((d, start, n, sequences + i, used[i]))
                used[i] += n
                heapq.heappush(queue, (cost + n + n * n / QUADRATIC, i))
                break
            if used[i] + smallest <= capacity:  # full ones never come back
                passed.append((cost, i))
        else:
            uncut.append((n, d, start))
        for entry in passed:
            heapq.heappush(queue, entry)
    room = [[sequences + i, used[i], capacity] for i in range(bins) if used[i] < capacity]
    left = sum(r[0] for r in uncut) - sum(r[2] - r[1] for r in room)
    sequences += bins
    for bit in reversed(range(left.bit_length() if left > 0 else 0)):
        if left >> bit & 1:
            size = 1 << bit
            room += [[sequences + k, 0, min(size, capacity)] for k in range(max(1, size // capacity))]
            sequences += max(1, size // capacity)
    at = 0
    for n, d, start in uncut:
        while n:
            seq, used_up, size = room[at]
            cut = min(n, size - used_up)
            pieces.append((d, start, cut, seq, used_up))
            room[at][1] += cut
            at += room[at][1] == size
            n, start = n - cut, start + cut
    return pieces


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY,
         group_tokens: int = GROUP_TOKENS, *, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece; ``with_ids`` adds the piece's token ids."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    end = np.array([end_id], "<u4").tobytes()

    def flush(held, task, first):
        pieces = pack_group([len(ids) // 4 for _, ids in held], capacity)
        rows = []
        for d, start, n, seq, off in pieces:
            o, ids = held[d]
            part = ids[4 * start:4 * (start + n)]
            rows.append((o, start, n, zlib.crc32(part), len(ids) // 4, (task << 40) + first + seq, off,
                         np.frombuffer(part, "<u4").astype(np.int32) if with_ids else None))
        cols = list(zip(*rows))
        out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.list_(pa.int32()))],
                                         ["ord", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])
        return out, first + max(p[3] for p in pieces) + 1

    def run(batches):
        tok = CachedTokenizer(tokenizer_path)
        task, first, held, tokens = TaskContext.get().partitionId(), 0, [], 0
        for b in small_batches(batches, lean=True):
            for o, text in zip(b.column("ord").to_pylist(), byte_list(b.column("text"))):
                ids = tok.encode(text) + end
                held.append((o, ids))
                tokens += len(ids) // 4
                if tokens >= group_tokens:
                    out, first = flush(held, task, first)
                    held, tokens = [], 0
                    yield out
        if held:
            yield flush(held, task, first)[0]

    schema = "ord long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"
    return keyed(docs, id_col, text_col).select("ord", "text").mapInArrow(run, schema)


def as_contract(pieces: DataFrame) -> DataFrame:
    return pieces.select(original_id().alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
