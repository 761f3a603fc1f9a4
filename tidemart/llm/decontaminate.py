"""Benchmark decontamination by edit distance (op 5).

The CGK embedding walks through a text with random steps: at step j it stays on
a word or moves on, as a random bit of (j, word) says. Two texts at a small
edit distance end up in step again after each edit, so their embeddings are
close in Hamming distance. Bit-sampling LSH hashes a few sampled positions of
the embedding; ``repeats`` independent walks reach the target recall. Document
windows of an item's size whose hash equals the item's are verified by the
exact word edit distance, and only verified passages count.

Documents are cut into windows that start at every ``stride``-th word; items
are embedded from each of their first ``stride`` words, so a copy always has a
start in common with some window and the stride costs no exact copy. Items are
grouped into size classes; a class's windows have its smallest item's size.

Items too short for the embedding are looked for without edits: the hash of
every window of their size meets theirs, and equal words decide.

The items' hashes go to the tasks in blocks of bounded items and characters (all
blocks are run, each is released after its search), so documents are never
shuffled and nothing depends on how many documents share a passage. The random
bits are drawn from (step, word) when they are needed; no table of them is kept.

Words: lower case, ASCII punctuation and white space separate; in scripts
written without spaces every character is a word. Defined results: NULL or empty
texts have no words; items of fewer than ``MIN_EXACT_WORDS`` words are no
passages and match nothing; repeated documents or items give a row each
per distinct pair; a pair is reported once, at its best passage (fewest edits,
then the first); empty tables give no rows.
"""

from __future__ import annotations

import math
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import release_memory, write_and_reread
from .word_arrays import mixed

MAX_EDIT_SHARE = 0.15  # edits per item word
MIN_ITEM_WORDS = 8     # shorter items are matched exactly
MIN_EXACT_WORDS = 4    # what is shorter still is in too many clean texts to be a passage
TARGET_RECALL = 0.95
SAMPLES = 4            # sampled positions in a hash
CLASS_RATIO = 1.5      # sizes in a class are within this factor
BLOCK_ITEMS = 10_000
BLOCK_CHARS = 16 << 20
VERIFY_CELLS = 4 << 20  # words of the windows verified at once
MAX_STRIDE = 8
WALKS_AT_ONCE = 1 << 15
WORDS_AT_ONCE = 500_000

_SPLIT = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


#: Letters of scripts written without spaces (Thai to Khmer, kana, Han).
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
                       "\uf900-\ufaff\U00020000-\U0003ffff])")


def words_of(text: str | None) -> list[bytes]:
    t = (text or "").lower()
    if not t.isascii() and _UNSPACED.search(t):
        t = _UNSPACED.sub(r" \1 ", t)
    return t.encode().translate(_SPLIT).split()


def repeats_for(target_recall: float, max_edit_share: float, samples: int) -> int:
    """Independent walks needed: an edit leaves the walks apart for a few steps,
    on average about one and a half positions per edited word (tests measure
    it), so a sampled position agrees with probability 1 - 1.5 * share; all
    samples must agree in one of the walks."""
    hit = max(1e-3, 1 - 1.5 * max_edit_share) ** samples
    return max(1, math.ceil(math.log(1 - target_recall) / math.log(1 - hit)))


class ItemIndex:
    """Embedded items of one block, as the tasks receive it."""

    def __init__(self, items: list[tuple[object, str]], *, max_edit_share, min_item_words,
                 target_recall, samples, seed=20240229):
        self.max_edit_share = max_edit_share
        vocab: dict[bytes, int] = {}
        self.ids, self.items = [], []
        for i, text in items:
            w = words_of(text)
            if len(w) >= min(min_item_words, MIN_EXACT_WORDS):
                self.ids.append(i)
                self.items.append(np.array([vocab.setdefault(x, len(vocab) + 1) for x in w], np.int32))
        self.vocab = vocab  # code 0: any word that stands in no item
        rng = np.random.default_rng(seed)
        size = np.array([len(x) for x in self.items], np.int64)
        self.exact = self._exact(np.flatnonzero(size < min_item_words))
        self.classes = []
        low = min_item_words
        repeats = repeats_for(target_recall, max_edit_share, samples)
        while len(size) and low <= size.max():
            high = max(low + 1, int(low * CLASS_RATIO))
            members = np.flatnonzero((size >= low) & (size < high))
            if len(members):
                least = int(size[members].min())
                stride = max(1, min(MAX_STRIDE, least // 4))
                # half a word a step on average: the walk spans the window
                steps = max(samples, int(1.5 * (least - stride)))
                for _ in range(repeats):
                    self.classes.append(self._walk(members, stride, steps, samples, rng))
            low = high

    def _exact(self, members) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By size: sorted window hashes of the short items, and the items."""
        out = {}
        for n in {len(self.items[m]) for m in members}:
            some = np.array([m for m in members if len(self.items[m]) == n])
            keys = window_hashes(np.concatenate([self.items[m] for m in some]), n)[::n]
            order = np.argsort(keys, kind="stable")
            out[n] = keys[order], some[order]
        return out

    def exact_matches(self, codes, doc_start, doc_size):
        """(document, item, 0, from, to) of the first copy of each short item."""
        best = {}
        for n, (keys, items) in sorted(self.exact.items()):
            h = window_hashes(codes, n)
            left = np.searchsorted(keys, h, "left")
            count = np.searchsorted(keys, h, "right") - left
            for at in np.flatnonzero(count).tolist():
                d = int(np.searchsorted(doc_start, at, "right")) - 1
                if at + n > doc_start[d] + doc_size[d]:
                    continue  # the window leaves its document
                for item in items[left[at]:left[at] + count[at]].tolist():
                    begin = at - int(doc_start[d])
                    if (d, item) not in best and (codes[at:at + n] == self.items[item]).all():
                        best[d, item] = (0, begin, begin + n)
        return [(d, i, *v) for (d, i), v in best.items()]

    def _walk(self, members, stride, steps, samples, rng):
        at = np.sort(rng.choice(steps, samples, replace=False))
        mult = rng.integers(1, 1 << 62, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        walk = {"stride": stride, "seed": rng.integers(0, 1 << 62, dtype=np.uint64), "words": len(self.vocab) + 1,
                "at": set(at.tolist()), "mult": mult, "steps": steps}
        pad = np.zeros(steps + stride, np.int32)
        flat = np.concatenate([np.concatenate([self.items[m], pad]) for m in members])
        base = np.cumsum([0] + [len(self.items[m]) + len(pad) for m in members[:-1]])
        begin = (base[:, None] + np.arange(stride)).ravel()
        keys = self.embed(flat, begin, walk)
        order = np.argsort(keys, kind="stable")
        walk["keys"] = keys[order]
        walk["item"] = np.repeat(members, stride)[order]
        walk["offset"] = np.tile(np.arange(stride), len(members))[order]
        table = np.zeros(1 << 18, bool)
        table[(walk["keys"] >> np.uint64(46)).astype(np.int64)] = True
        walk["table"] = table
        return walk

    @staticmethod
    def embed(codes: np.ndarray, begin: np.ndarray, walk: dict) -> np.ndarray:
        """Hashes of the sampled embedding positions of the walks from ``begin``
        (``codes`` must reach ``steps`` words further)."""
        out = np.empty(len(begin), np.uint64)
        for a in range(0, len(begin), WALKS_AT_ONCE):
            pos = begin[a:a + WALKS_AT_ONCE].astype(np.int64)
            h = np.full(len(pos), 0x9E3779B97F4A7C15, np.uint64)
            k = 0
            for j in range(walk["steps"]):
                if j % 64 == 0:  # the bits of the next 64 steps of every word
                    start = np.uint64(int(walk["seed"]) * (j // 64 + 1) % (1 << 64))
                    bits = mixed(np.arange(walk["words"], dtype=np.uint64) + start)
                word = codes[pos]
                if j in walk["at"]:
                    h = (h ^ (word.astype(np.uint64) + np.uint64(k + 1))) * walk["mult"][k]
                    h ^= h >> np.uint64(29)
                    k += 1
                    if k == len(walk["mult"]):
                        break
                pos += ((bits[word] >> np.uint64(j % 64)) & np.uint64(1)).view(np.int64)
            out[a:a + WALKS_AT_ONCE] = h * np.uint64(0xD6E8FEB86659FD93)
        return out

    def candidates(self, codes, doc_start, doc_size):
        """Rows (document, item, word place where the item would begin)."""
        reach = max((w["steps"] for w in self.classes), default=0)
        padded = np.concatenate([codes, np.zeros(reach + 1, np.int32)])
        found = []
        begins = {}
        for walk in self.classes:
            s = walk["stride"]
            if s not in begins:
                n = -(-doc_size // s)
                doc = np.repeat(np.arange(len(doc_size)), n)
                local = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                begins[s] = (doc, local * s, doc_start[doc] + local * s)
            doc, local, begin = begins[s]
            keys = self.embed(padded, begin, walk)
            maybe = np.flatnonzero(walk["table"][(keys >> np.uint64(46)).astype(np.int64)])
            if not len(maybe):
                continue
            left = np.searchsorted(walk["keys"], keys[maybe], "left")
            right = np.searchsorted(walk["keys"], keys[maybe], "right")
            n = right - left
            if not n.sum():
                continue
            at = np.repeat(maybe, n)
            which = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(left, n)
            found.append(np.stack([doc[at], walk["item"][which], local[at] - walk["offset"][which]], 1))
        return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 3), np.int64)

    def verify(self, codes, doc_start, doc_size, cand):
        """Best passage per (document, item): (document, item, edits, from, to)."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for item in np.unique(cand[:, 1]):
            pattern = self.items[item]
            most = int(self.max_edit_share * len(pattern))
            rows = cand[cand[:, 1] == item]
            # neighbouring starts are looked at together, MAX_STRIDE words past the
            # first of them at most: the margin holds the passage of each
            order = np.lexsort((rows[:, 2], rows[:, 0]))
            rows = rows[order]
            margin = most + MAX_STRIDE
            head = np.ones(len(rows), bool)
            head[1:] = (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 2]) > 1)
            chain = np.maximum.accumulate(np.where(head, np.arange(len(rows)), 0))
            head |= (rows[:, 2] - rows[chain, 2]) % (MAX_STRIDE + 1) == 0
            rows = rows[head]
            width = len(pattern) + 2 * margin
            at_once = max(1, VERIFY_CELLS // width)
            for a in range(0, len(rows), at_once):
                part = rows[a:a + at_once]
                first = part[:, 2] - margin
                grid = first[:, None] + np.arange(width)
                size = doc_size[part[:, 0]][:, None]
                inside = (grid >= 0) & (grid < size)
                text = np.where(inside, codes[np.clip(doc_start[part[:, 0]][:, None] + grid, 0, len(codes) - 1)], -1)
                edits, begin, end = best_passages(pattern, text)
                for (d, _, _), e, b, t, f, n in zip(part.tolist(), edits, begin, end, first.tolist(), size[:, 0]):
                    if e <= most:
                        now = (int(e), max(0, f + int(b)), min(int(n), f + int(t)))
                        key = (d, int(item))
                        if key not in best or now < best[key]:
                            best[key] = now
        return [(d, i, *v) for (d, i), v in sorted(best.items())]


def window_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Of each place, a hash of the ``n`` words from it (fewer places by n - 1)."""
    many = max(0, len(codes) - n + 1)
    h = np.zeros(many, np.uint64)
    for k in range(n):
        h = mixed(h ^ (codes[k:k + many].astype(np.uint64) + np.uint64(k << 32)))
    return h


def _last_row(pattern: np.ndarray, text: np.ndarray, free_start: bool) -> np.ndarray:
    """Edit distances of ``pattern`` to what ends at each place of each row of
    ``text``, beginning anywhere (``free_start``) or at the row's begin."""
    n, width = text.shape
    places = np.arange(width + 1, dtype=np.int32)
    row = np.zeros((n, width + 1), np.int32) if free_start else np.broadcast_to(places, (n, width + 1)).copy()
    for x in pattern:
        below = row + 1                                   # the pattern's word is left out
        below[:, 1:] = np.minimum(below[:, 1:], row[:, :-1] + (text != x))
        # a text word is left out: a running minimum along the row
        row = np.minimum.accumulate(below - places, axis=1) + places
    return row


def best_passages(pattern: np.ndarray, text: np.ndarray):
    """(edits, begin, end) of the passage of each row closest to ``pattern``:
    fewest edits, then the earliest end, then the shortest."""
    row = _last_row(pattern, text, True)
    end = row.argmin(axis=1)
    edits = row[np.arange(len(row)), end]
    # backwards from the end, anchored there, the passage's begin is where the
    # reversed pattern ends
    width = text.shape[1]
    back = end[:, None] - 1 - np.arange(width)
    turned = np.where(back >= 0, np.take_along_axis(text, np.clip(back, 0, width - 1), 1), -2)
    length = _last_row(pattern[::-1], turned, False).argmin(axis=1)
    return edits, end - length, end


def contaminated_passages(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id",
                          text: str = "text", item_id: str = "item_id", item_text: str = "text",
                          keep: list[str] | None = None,
                          max_edit_share: float = MAX_EDIT_SHARE, min_item_words: int = MIN_ITEM_WORDS,
                          target_recall: float = TARGET_RECALL, samples: int = SAMPLES,
                          block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``doc_id`` (and the columns ``keep``), ``item_id, edits, from_word,
    to_word`` of every passage within ``max_edit_share`` edits per item word."""
    spark = docs.sparkSession
    keep = list(keep or [])
    source = docs.select(F.col(doc_id).alias("doc_id"), *keep, F.col(text).alias("_text"))
    item_type = items.schema[item_id].dataType
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("item_id", item_type),
                           *[T.StructField(c, T.IntegerType()) for c in ("edits", "from_word", "to_word")]])
    distinct = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).distinct()
    size = distinct.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("chars")).first()
    n_blocks = max(1, -(-size["n"] // block_items), -(-size["chars"] // BLOCK_CHARS))
    out = None
    for k in range(n_blocks):
        block = distinct.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == k)
        rows = sorted(((r["i"], r["t"]) for r in block.collect()),  # about block_items rows
                      key=lambda r: (str(r[0]), r[1] or ""))
        index = spark.sparkContext.broadcast(ItemIndex(
            rows, max_edit_share=max_edit_share, min_item_words=min_item_words,
            target_recall=target_recall, samples=samples))
        part = source.mapInArrow(_search(index, schema.names), schema)
        if n_blocks > 1:  # one block at a time is held
            part = write_and_reread(part, "passages")
            index.unpersist()
        out = part if out is None else out.unionByName(part)
    return out


def _search(index, names):
    def run(batches):
        idx: ItemIndex = index.value
        get = idx.vocab.get

        def hits_of(rows, codes):
            """(row, item, edits, from, to) for some documents of a batch."""
            size = np.array([len(c) for c in codes], np.int64)
            if not size.sum():
                return []
            flat, start = np.concatenate(codes), np.cumsum(size) - size
            found = idx.verify(flat, start, size, idx.candidates(flat, start, size))
            found += idx.exact_matches(flat, start, size)
            return [(rows[d], idx.ids[i], *rest) for d, i, *rest in found]

        for b in batches:
            if not b.num_rows or not (idx.classes or idx.exact):
                continue
            hits, rows, codes, words = [], [], [], 0
            for k, t in enumerate(b.column(b.num_columns - 1)):
                w = words_of(t.as_py())
                rows.append(k)
                codes.append(np.fromiter((get(x, 0) for x in w), np.int32, len(w)))
                words += len(w)
                if words >= WORDS_AT_ONCE:
                    hits += hits_of(rows, codes)
                    rows, codes, words = [], [], 0
            if rows:
                hits += hits_of(rows, codes)
            if not hits:
                continue
            of = pa.array([h[0] for h in hits])
            yield pa.RecordBatch.from_arrays(
                [*[c.take(of) for c in b.columns[:-1]], pa.array([h[1] for h in hits]),
                 *[pa.array([h[k] for h in hits], pa.int32()) for k in (2, 3, 4)]], names=names)
        release_memory()

    return run
