"""Sum-of-squares online packing of tokenised documents into windows.

Every document becomes one run of token ids (its tokens and a closing id).
Whole windows are cut off the front of a run at once; the rest, shorter than
a window, is one item of an online bin packing.  A level array counts the
open windows of each fill; an item goes to the level for which the sum of the
squared counts grows least (Csirik et al.), which keeps no fill level from
piling up.  When a task's rows end, the windows still open are merged by
cutting pieces, and the last rest is cut at powers of two, so no window is
padded except inside a longer rest.

Each task packs its own rows, hence no shuffle, and tokens held are those of
the open windows only.  Order of rows in a task is the order of the scan, so
a repeated task gives the same windows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sessionlab.llm.common import NO_ID, crc32, kept, keyed_text, slices

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

#: Windows a task may number.
WINDOWS_PER_TASK = 2 ** 40
SLICE_BYTES = 1 << 20


class SumOfSquares:
    """Level array of open windows.  ``place(piece)`` puts a piece of 1 to
    width - 1 ids and returns the windows that became full."""

    def __init__(self, width: int):
        self.width = width
        self.count = np.zeros(width + 1, dtype=np.int64)   # open windows by fill
        self.open: dict[int, list] = {}                    # fill -> windows (lists of pieces)

    def level_for(self, size: int) -> int:
        """Fill whose use adds least to the sum of squared counts: moving a
        window from h to h + s adds 2 (N[h+s] - N[h]) + 2, a full window
        leaves the sum, a new window leaves level 0 out of it.  Ties go to
        the highest fill."""
        w = self.width
        n = self.count
        top = w - size
        grow = 2 * (n[size:w] - n[:top]) + 2               # h = 0 .. top - 1
        grow[0] = 2 * n[size] + 1
        usable = n[:top] > 0
        usable[0] = True
        grow = np.where(usable, grow, np.iinfo(np.int64).max)
        best = len(grow) - 1 - int(np.argmin(grow[::-1]))
        if n[top] > 0 and 1 - 2 * n[top] <= grow[best]:
            return top
        return best

    def place(self, piece) -> list:
        size = piece[2]
        h = self.level_for(size)
        if h:
            window = self.open[h].pop()
            self.count[h] -= 1
        else:
            window = []
        window.append(piece)
        fill = h + size
        if fill == self.width:
            return [window]
        self.count[fill] += 1
        self.open.setdefault(fill, []).append(window)
        return []

    def flush(self) -> list:
        """Merge the windows still open by cutting pieces; the last rest is
        cut into windows of falling powers of two."""
        rest = [p for fill in sorted(self.open, reverse=True) for w in self.open[fill] for p in w]
        self.open, self.count[:] = {}, 0
        total = sum(p[2] for p in rest)
        sizes = [self.width] * (total // self.width)
        tail = total % self.width
        sizes += [1 << b for b in range(tail.bit_length() - 1, -1, -1) if tail >> b & 1]
        out, it, have = [], iter(rest), None
        for size in sizes:
            window = []
            while size:
                if have is None:
                    have = next(it)
                doc, start, n, ids, total_n = have
                take = min(n, size)
                window.append((doc, start, take, ids[:take], total_n))
                have = (doc, start + take, n - take, ids[take:], total_n) if n > take else None
                size -= take
            out.append(window)
        return out


_SIGNS_END = re.compile(r"[.,;:!?#$%&*()\-_+=/|]+(?= |\Z)")


class ChunkEncoder:
    """Ids of whole texts as little-endian bytes, by way of the chunks between
    spaces and line feeds: a tokenizer whose pre-tokenizer drops white space
    (as the word-end BPE's does) gives a text the ids of its chunks in order.
    Short chunks are remembered, as most words of a corpus come again."""

    REMEMBERED, CHUNK, JOINED = 1_500_000, 64, 4096

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.known: dict[str, bytes] = {}
        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.special = list(special)
        self.mark, self.mark_id = next(reversed(special.items()), (None, None))
        # words need be encoded once without case and closing signs if the
        # tokenizer lower-cases and cuts before signs
        probe = dict(zip(["Mixed$$,", "mixed", "$$,"], self._alone(["Mixed$$,", "mixed", "$$,"])))
        self.reduces = probe["Mixed$$,"] == probe["mixed"] + probe["$$,"]
        vocab = tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocab.values(), default=0) + 1, dtype=bool)
        self.is_end[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters alone.  Each is one word of the tokenizer,
        whose last token is marked as a word's end, so they are encoded
        joined by spaces and cut after the ends; a group in which words and
        ends do not count the same is encoded the careful way."""
        groups = [words[i:i + self.JOINED] for i in range(0, len(words), self.JOINED)]
        out = []
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups],
                                                                     add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            ends = ((np.flatnonzero(self.is_end[ids]) + 1) * 4).tolist()
            if len(ends) == len(group) and ends[-1] == 4 * len(ids):
                raw, a = ids.tobytes(), 0
                for b in ends:
                    out.append(raw[a:b])
                    a = b
            else:
                out += self._encode(group)
        return out

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk.  Chunks are joined by a special token, which
        the tokenizer cuts out before anything else, and the ids are cut at
        its id; one that itself holds a special token is encoded alone."""
        if self.mark is None:
            return self._alone(chunks)
        own = [i for i, c in enumerate(chunks) if any(t in c for t in self.special)]
        alone = dict(zip(own, self._alone([chunks[i] for i in own])))
        plain = [c for i, c in enumerate(chunks) if i not in alone] if alone else chunks
        out = []
        joined = [self.mark.join(plain[i:i + self.JOINED]) for i in range(0, len(plain), self.JOINED)]
        # encode_batch_fast leaves out character offsets, which nothing reads
        for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(e.ids, dtype="<u4")
            cuts = (np.flatnonzero(ids == self.mark_id) * 4).tolist()
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(raw)])]
        if alone:
            rest = iter(out)
            out = [alone[i] if i in alone else next(rest) for i in range(len(chunks))]
        return out

    def _new(self, new: set[str]) -> dict[str, bytes]:
        """Encode chunks not seen before; short ones are remembered, the
        others returned."""
        known, parts = self.known, []
        letters, wanted = set(), []
        if self.reduces:
            # case and closing signs go from all chunks at once: a chunk has
            # no space, so they stay aligned
            for plain in (True, False):
                chunks = [c for c in new if c.isascii() == plain]
                joined = " ".join(chunks)
                cores = _SIGNS_END.sub("", joined.lower() if plain else joined).split(" ") if chunks else []
                for c, low in zip(chunks, cores):
                    if not low.isalpha() or len(c) > self.CHUNK:
                        wanted.append(c)
                        continue
                    letters.add(low)
                    if low != c:
                        tail = c[len(low):]
                        parts.append((c, low, tail))
                        if tail and tail not in known:
                            known[tail] = self._alone([tail])[0]
        else:
            wanted = list(new)
        letters = [w for w in letters if w not in known]
        known.update(zip(letters, self._words(letters)))
        for c, low, tail in parts:
            known[c] = known[low] + known[tail] if tail else known[low]
        ids = dict(zip(wanted, self._encode(wanted)))
        known.update((c, i) for c, i in ids.items() if len(c) <= self.CHUNK)
        return {c: i for c, i in ids.items() if len(c) > self.CHUNK}

    def _alone(self, chunks: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.REMEMBERED:
            self.known = {}
        known = self.known
        chunks, ends = [], [0]
        for t in texts:
            chunks += t.replace("\n", " ").split(" ")
            ends.append(len(chunks))
        ids = list(map(known.get, chunks))
        missing, at = [], -1
        for _ in range(ids.count(None)):
            at = ids.index(None, at + 1)
            missing.append(at)
        long = self._new({chunks[i] for i in missing})
        for i in missing:
            c = chunks[i]
            ids[i] = known[c] if c in known else long[c]
        return [b"".join(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def encoder(path: str) -> ChunkEncoder:
    """One per Python worker: later tasks of the worker find its words, until
    it reads texts for another operator."""
    return kept(("packing", path), lambda: _encoder(path))


def _encoder(path: str) -> ChunkEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return ChunkEncoder(Tokenizer.from_file(path))


def _pack(batches: Iterator[pa.RecordBatch], tokenizer_path: str, end_id: int, width: int, with_ids: bool = True):
    schema = _ARROW if with_ids else pa.schema(list(_ARROW)[:-1])
    encode = encoder(tokenizer_path)
    packer, out = SumOfSquares(width), []
    next_id = (TaskContext.get().partitionId() if TaskContext.get() else 0) * WINDOWS_PER_TASK

    def emit(window):
        nonlocal next_id
        at = 0
        for doc, start, n, ids, total in window:
            raw = ids.tobytes()
            out.append((None if doc == NO_ID else doc, start, n, crc32(raw), total, next_id, at, raw)[:len(schema)])
            at += n
        next_id += 1

    def batch():
        rows = list(zip(*out)) or [[]] * len(schema)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(rows, schema)], schema=schema)

    for part in slices(batches, SLICE_BYTES, keep=True):
        keys = part.column("k").to_pylist()
        for doc, raw in zip(keys, encode(part.column("text").to_pylist())):
            ids = np.frombuffer(raw + int(end_id).to_bytes(4, "little"), dtype="<u4")
            n = len(ids)
            whole = n - n % width
            for s in range(0, whole, width):
                emit([(doc, s, width, ids[s:s + width], n)])
            if n > whole:
                for w in packer.place((doc, whole, n - whole, ids[whole:], n)):
                    emit(w)
        yield batch()
    for w in packer.flush():
        emit(w)
    yield batch()


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         width: int = 2048, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """One row per piece: document, its place there, the crc of its ids, its
    window and place there, and the ids themselves (little-endian, left out
    without ``with_ids``).

    Null and empty texts are a run of the closing id alone; a null id stays
    null; repeated rows are packed each; an empty table gives no rows; other
    columns are not read.  Windows count from 0 in each task, task t from
    t * 2**40.
    """
    return keyed_text(docs, id_col, text_col).mapInArrow(
        lambda it: _pack(it, tokenizer_path, end_id, width, with_ids), SCHEMA if with_ids else SCHEMA.rpartition(",")[0])
