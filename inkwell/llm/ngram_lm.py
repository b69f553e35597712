"""Interpolated modified Kneser-Ney language model, counted in Spark, stored as sorted hash arrays.

Counting. Each task hashes its words (64 bits), sums equal n-grams of the model's order in memory, and
sends the sums as blobs to shards by the leading bits of the context's hash. A shard's task merges its
blobs, writes its part of that order, and sends on, for each n-gram without its first word, in how many
contexts it was seen. Those are the counts of the next lower order, merged the same way, down to single words. An
n-gram's entry is its 64-bit key and a one-byte count; counts beyond that stand in a short list beside it.

Model. Every shard is a few flat arrays sorted by key in the shared folder. As keys begin with the context's leading
bits, the shards together are one sorted array.

Hot contexts. A first pass finds every context that holds at least one part in S of all tokens, S being the number of
shards (it keeps at most SPREAD S). Their n-grams go to shards by the hash of context and word, so no task holds all words that
follow a frequent context; each shard sends its share of the context's totals, which a second small pass adds up. A shard's blobs
are merged whenever PILE bytes have come, so a task holds its distinct n-grams, not every blob that names them.

Reading. Workers map the files into memory and look keys up
by binary search; pages that are not touched are not read, and the file cache is shared by all workers of a
machine. On a file system that cannot be mapped, a worker copies a shard when it first needs it.

Scoring. p(w|v) = max(c(vw) - D, 0)/c(v) + g(v) p(w|v'), with v' the context v without its first word, down to
q(w) = max(n(w) - D', 0)/n + g'/(V + 1), with n(w) the number of contexts of w, and three discounts per order
from the counts of counts. An unknown context leaves the shorter one's value, an unknown word its uniform share. A text
begins with as many start marks as the longest context holds. The order is a parameter, two by default: the
README has the disk that two takes.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import doc_crc, drop, shared_path, small_batches, store, text_or_empty
from inkwell.llm.words import LOWER, batch_word_hashes, mix

ORDER = 2              # words of the longest n-gram
FLUSH = 1 << 21        # tokens that a task sums before it sends them
SPREAD = 2             # a task names a context that holds one part in SPREAD * shards of what it sums
PILE = 1 << 25         # bytes of blobs that a shard's task holds before it merges them
START = np.uint64(0x5BD1E995A5A5F00D)  # the context of a text's first word
END = np.uint64(0xC2B2AE3D27D4EB4F)    # the token that closes a text
BLOBS = "kind string, shard long, a binary, b binary, c binary, d binary"
ORDER_STATS = ("n1", "n2", "n3", "n4", "types", "total")


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and its end, and each text's first token (one more at the end)."""
    words, firsts = batch_word_hashes([(t or "").encode("utf-8", "replace").translate(LOWER) for t in texts])
    n = len(firsts) - 1
    out = np.insert(words, firsts[1:], END) if n else words
    return out, firsts + np.arange(n + 1)


def histories(h: np.ndarray, firsts: np.ndarray, order: int) -> list[np.ndarray]:
    """The hashes of the one, two, ... ``order`` - 1 tokens before each token."""
    out = []
    for _ in range(order - 1):
        v = np.empty_like(h)
        v[1:] = mix(out[-1][:-1] * np.uint64(3)) + h[:-1] if out else h[:-1]
        v[firsts[:-1]] = START
        out.append(v)
    return out


def pair_key(v48: np.ndarray, w48: np.ndarray) -> np.ndarray:
    """Key of a pair: the context's leading 16 bits, then 48 bits of both."""
    return (v48 >> np.uint64(32) << np.uint64(48)) | (mix(v48 * np.uint64(0x9E3779B97F4A7C15) + w48) >> np.uint64(16))


def spread_key(v48: np.ndarray, w48: np.ndarray) -> np.ndarray:
    """Key of a pair whose context is hot: its leading bits follow the word as well."""
    return mix(mix(v48 * np.uint64(0x9E3779B97F4A7C15)) + w48)


def _among(values: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted array ``few``."""
    if not len(few):
        return np.zeros(len(values), bool)
    return few[np.minimum(np.searchsorted(few, values), len(few) - 1)] == values


def _pack48(x: np.ndarray) -> tuple[bytes, bytes]:
    return (x >> np.uint64(16)).astype("<u4").tobytes(), (x & np.uint64(0xFFFF)).astype("<u2").tobytes()


def _unpack48(hi: bytes, lo: bytes) -> np.ndarray:
    return np.frombuffer(hi, "<u4").astype(np.uint64) << np.uint64(16) | np.frombuffer(lo, "<u2")


def _varcounts(c: np.ndarray) -> bytes:
    """Counts, one byte each where all fit, else eight."""
    return c.astype(np.uint8).tobytes() if len(c) == 0 or c.max() < 256 else c.astype("<u8").tobytes()


def _counts(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if len(data) == n else "<u8").astype(np.int64)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64())] + [pa.array(c, pa.binary()) for c in cols[2:]],
        names=["kind", "shard", "a", "b", "c", "d"])


def _slices(prefix: np.ndarray):
    """(value, start, end) of each run of equal values in a sorted array."""
    if len(prefix):
        at = np.flatnonzero(np.diff(prefix, prepend=prefix[0] + 1))
        for s, e in zip(at.tolist(), np.append(at[1:], len(prefix)).tolist()):
            yield int(prefix[s]), s, e


def word_bits(bits: int) -> int:
    """Shards of the word tables, as bits: they follow the vocabulary, which grows slower than the pairs."""
    return max(1, (bits + 6) // 2)


def _pack_grams(kind: str, shard: int, head, word, times, shorter) -> tuple:
    """A blob of counted n-grams, sorted by the 48-bit hash of their context: each context once, with the number of
    its words and its shorter contexts, then the words and the counts."""
    at = np.flatnonzero(np.diff(head, prepend=head[0] + np.uint64(1)))
    runs = np.diff(np.append(at, len(head))).astype(np.uint64)
    a = np.concatenate([head[at], runs, *[x[at] for x in shorter]]).astype("<u8")
    return (kind, shard, a.tobytes(), *_pack48(word), _varcounts(times))


def _gram_blobs(order: int, head: np.ndarray, word: np.ndarray, times: np.ndarray, shorter: list[np.ndarray], bits: int,
                hot: dict[int, np.ndarray]):
    """Blobs of n-grams, which come sorted by their context: by shards of the context, or of the pair where it is hot."""
    heavy = _among(head, hot[order])
    columns = [head, word, times, *shorter]
    light = [x[~heavy] for x in columns] if heavy.any() else columns
    for shard, s, e in _slices(light[0] >> np.uint64(48 - bits)):
        head, word, times, *shorter = [x[s:e] for x in light]
        yield _pack_grams(f"gram{order}", shard, head, word, times, shorter)
    split = [x[heavy] for x in columns]
    place = spread_key(split[0], split[1]) >> np.uint64(64 - bits)
    by = np.lexsort((split[0], place))
    for shard, s, e in _slices(place[by]):
        head, word, times, *shorter = [x[by[s:e]] for x in split]
        yield _pack_grams(f"hot{order}", shard, head, word, times, shorter)


def _frequent(bits: int, order: int):
    """Map side: of each FLUSH tokens, the contexts that hold one part in SPREAD * shards of them, and (0, 0, tokens)."""
    def named(parts):
        n = sum(len(p[0]) for p in parts)
        found = [(0, 0, n)]
        for k, history in enumerate(zip(*parts), 2):
            v, c = np.unique(np.concatenate(history) >> np.uint64(16), return_counts=True)
            often = c * (SPREAD << bits) >= n
            found += [(k, int(x), int(y)) for x, y in zip(v[often], c[often])]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["k", "v", "n"])

    def handle(batches):
        parts, size = [], 0
        for batch in batches:
            h, firsts = tokens(batch.column("text").to_pylist())
            v = histories(h, firsts, order)
            for s in range(0, len(h), FLUSH):
                parts.append([x[s:s + FLUSH] for x in v])
                size += len(parts[-1][0])
                if size >= FLUSH:
                    yield named(parts)
                    parts, size = [], 0
        if size:
            yield named(parts)

    return handle


def hot_contexts(texts: DataFrame, bits: int, order: int) -> dict[int, np.ndarray]:
    """Of each order, the sorted 48-bit hashes of its hot contexts.

    A context that holds at least 1/S of all tokens is named for all but 1/(SPREAD S) of them, so it is found; what is
    kept holds 1/(SPREAD S) or more, which bounds the list whatever the corpus. Which contexts are hot moves n-grams to
    other shards and changes no count.
    """
    sums = store(texts.mapInArrow(_frequent(bits, order), "k long, v long, n long")
                 .groupBy("k", "v").agg(F.sum("n").alias("n")), "contexts")
    total = sums.where("k = 0").agg(F.max("n")).first()[0] or 0
    kept = sums.where((F.col("k") > 0) & (F.col("n") * (SPREAD << bits) >= total)).collect()  # at most SPREAD * S an order
    drop(sums)
    return {k: np.array(sorted(r["v"] for r in kept if r["k"] == k), np.uint64) for k in range(2, order + 1)}


def _sum_tokens(bits: int, order: int, hot: dict[int, np.ndarray]):
    """Map side: blobs of word counts and of n-gram counts."""
    def blobs(parts):
        h = np.concatenate([p[0] for p in parts])
        u, inv = np.unique(h, return_inverse=True)
        word_n = np.bincount(inv, minlength=len(u))
        for shard, s, e in _slices(u >> np.uint64(64 - word_bits(bits))):
            yield ("word", shard, u[s:e].tobytes(), _varcounts(word_n[s:e]), b"", b"")
        *shorter, longest = [np.concatenate(x) for x in zip(*[p[1] for p in parts])]
        contexts, place, ids = np.unique(longest, return_index=True, return_inverse=True)
        gram = np.sort(ids.astype(np.int64) * len(u) + inv)
        first = np.flatnonzero(np.diff(gram, prepend=-1))
        times = np.diff(np.append(first, len(gram)))
        ctx, word = gram[first] // len(u), gram[first] % len(u)
        yield from _gram_blobs(order, contexts[ctx] >> np.uint64(16), u[word] >> np.uint64(16), times,
                               [x[place[ctx]] >> np.uint64(16) for x in reversed(shorter)], bits, hot)

    def handle(batches):
        parts, size = [], 0
        for batch in batches:
            h, firsts = tokens(batch.column("text").to_pylist())
            v = histories(h, firsts, order)
            for s in range(0, len(h), FLUSH):
                parts.append((h[s:s + FLUSH], [x[s:s + FLUSH] for x in v]))
                size += len(parts[-1][0])
                if size >= FLUSH:
                    yield _rows(list(blobs(parts)))
                    parts, size = [], 0
        if size:
            yield _rows(list(blobs(parts)))

    return handle


class Files:
    """Flat arrays in the shared folder, written whole and read as memory maps."""

    def __init__(self, uri: str):
        self.uri = uri

    def _fs(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.uri)

    def write(self, name: str, array: np.ndarray) -> None:
        """Write under another name, then rename: a task that runs again gives the same file."""
        fs, path = self._fs()
        fs.create_dir(path, recursive=True)
        part = f"{path}/.{name}-{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as out:
            out.write(memoryview(np.ascontiguousarray(array)).cast("B") if array.size else b"")
        fs.move(part, f"{path}/{name}")

    def read(self, name: str, dtype) -> np.ndarray:
        from pyarrow import fs as pafs

        fs, path = self._fs()
        info = fs.get_file_info(f"{path}/{name}")
        if info.type == pafs.FileType.NotFound or not info.size:
            return np.empty(0, dtype)
        if isinstance(fs, pafs.LocalFileSystem):
            return np.memmap(f"{path}/{name}", dtype, "r")
        with fs.open_input_stream(f"{path}/{name}") as src, tempfile.TemporaryFile() as dst:
            while chunk := src.read(1 << 24):  # a worker's own copy, gone with its last mapping
                dst.write(chunk)
            dst.flush()
            return np.memmap(dst, dtype, "r")


def _count_of_counts(c: np.ndarray) -> list[int]:
    b = np.bincount(np.minimum(c, 5), minlength=6)
    return [int(b[1]), int(b[2]), int(b[3]), int(b[4]), len(c), int(c.sum())]


def _merge(uri: str, bits: int, hot: dict[int, np.ndarray]):
    """Reduce side: merge the blobs of each shard, write its arrays, send on the counts of the next lower order."""
    files = Files(uri)

    def stat(kind, shard, c):
        return (f"{kind} stat", shard, np.array(_count_of_counts(c), "<i8").tobytes(), b"", b"", b"")

    def summed_words(rows):
        w = np.concatenate([np.frombuffer(r[0], "<u8") for r in rows])
        n = np.concatenate([_counts(r[1], len(r[0]) // 8) for r in rows])
        u, inv = np.unique(w, return_inverse=True)
        total = np.zeros(len(u), np.int64)
        np.add.at(total, inv, n)
        return u, total

    def summed_grams(order, rows):
        """Contexts, their shorter ones, words, and of each n-gram (sorted by context) the places in both and its count."""
        heads, runs, ws, ns, shorter = [], [], [], [], [[] for _ in range(order - 2)]
        for a, hi, lo, times in rows:
            w = _unpack48(hi, lo)
            a = np.frombuffer(a, "<u8").reshape(order, -1)
            heads.append(a[0])
            runs.append(a[1].astype(np.int64))
            for x, y in zip(shorter, a[2:]):
                x.append(y)
            ws.append(w)
            ns.append(_counts(times, len(w)))
        w, n = np.concatenate(ws), np.concatenate(ns)
        uv, place, iv = np.unique(np.concatenate(heads), return_index=True, return_inverse=True)
        shorter = [np.concatenate(x)[place] for x in shorter]
        uw, iw = np.unique(w, return_inverse=True)
        pid = np.repeat(iv.astype(np.int64), np.concatenate(runs)) * len(uw) + iw
        del w, iv, iw, heads, runs, ws
        by = np.argsort(pid)
        pid, n = pid[by], n[by]
        first = np.flatnonzero(np.diff(pid, prepend=-1))
        n = np.add.reduceat(n, first)
        pid = pid[first]
        return uv, shorter, uw, pid // len(uw), pid % len(uw), n

    def compact(kind, shard, rows):
        """One blob for many of a shard."""
        if not kind.startswith(("gram", "hot")):
            u, n = summed_words(rows)
            return (u.tobytes(), _varcounts(n), b"", b"")
        uv, shorter, uw, iv, iw, n = summed_grams(int(kind.lstrip("gramhot")), rows)
        return _pack_grams(kind, shard, uv[iv], uw[iw], n, [x[iv] for x in shorter])[2:]

    def words(kind, shard, rows):
        u, total = summed_words(rows)
        files.write(f"{kind}-{shard}.key", u)
        files.write(f"{kind}-{shard}.n", total)
        yield stat(kind, shard, total)

    def grams(kind, shard, rows):
        order = int(kind.lstrip("gramhot"))
        uv, shorter, uw, iv, iw, n = summed_grams(order, rows)
        starts = np.flatnonzero(np.diff(iv, prepend=-1))
        ctx = np.stack([np.add.reduceat(x, starts) for x in (n, n == 1, n == 2, n >= 3)], 1).astype(np.float64)
        if kind.startswith("hot"):  # this shard's part of the totals
            yield (f"ctx{order}", shard, uv.tobytes(), ctx.tobytes(), b"", b"")
            key = spread_key(uv[iv], uw[iw])
        else:
            files.write(f"ctx{order}-{shard}.key", uv)
            files.write(f"ctx{order}-{shard}.n", ctx)
            key = pair_key(uv[iv], uw[iw])
        by = np.argsort(key)
        key, count = key[by], n[by]
        big = count > 254
        files.write(f"{kind}-{shard}.key", key)
        files.write(f"{kind}-{shard}.n", np.where(big, 255, count).astype(np.uint8))
        files.write(f"{kind}-{shard}.bigkey", key[big])
        files.write(f"{kind}-{shard}.bign", count[big])
        yield stat(f"gram{order}", shard, n)
        if order > 2:  # each n-gram counts once for what is left of it without its first word
            by = np.lexsort((iw, shorter[0][iv]))
            head, iw = shorter[0][iv][by], iw[by]
            first = np.flatnonzero((np.diff(head, prepend=head[0] + np.uint64(1)) != 0) | (np.diff(iw, prepend=-1) != 0))
            yield from _gram_blobs(order - 1, head[first], uw[iw[first]], np.diff(np.append(first, len(iw))),
                                   [x[iv[by[first]]] for x in shorter[1:]], bits, hot)
            return
        after = np.bincount(iw, minlength=len(uw))
        for to, s, e in _slices(uw >> np.uint64(48 - word_bits(bits))):
            yield ("next", to, uw[s:e].tobytes(), _varcounts(after[s:e]), b"", b"")

    def merged(kind, shard, rows):
        return _rows(list((grams if kind.startswith(("gram", "hot")) else words)(kind, shard, rows)))

    def handle(batches):
        held, key, size, bound = [], None, 0, PILE
        for batch in batches:
            for i in range(batch.num_rows):
                kind, shard, *blob = [c[i].as_py() for c in batch.columns]
                if held and (kind, shard) != key:
                    yield merged(*key, held)
                    held, size, bound = [], 0, PILE
                key = kind, shard
                held.append(blob)
                size += sum(map(len, blob))
                if size > bound:
                    held = [compact(*key, held)]
                    size = sum(map(len, held[0]))
                    bound = max(PILE, 2 * size)
        if held:
            yield merged(*key, held)

    return handle


@dataclass
class Order:
    """Counts of counts of one order, and its three discounts."""

    n1: int
    n2: int
    n3: int
    n4: int
    types: int
    total: int

    def discounts(self) -> np.ndarray:
        """0, D1, D2, D3+; the usual 1/2, 1, 3/2 where the counts of counts cannot give them."""
        n1, n2, n3, n4 = self.n1, self.n2, self.n3, self.n4
        if not (n1 and n2 and n3 and n4):
            return np.array([0, 0.5, 1.0, 1.5])
        y = n1 / (n1 + 2 * n2)
        d = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
        return np.clip(d, [0, 0.05, 0.05, 0.05], [0, 1, 2, 3])


@dataclass
class Model:
    uri: str
    bits: int
    word: Order
    next: Order
    grams: dict[int, Order]
    hot: dict[int, tuple[np.ndarray, np.ndarray]]  # of each order, its hot contexts and their totals

    def table(self, kind: str, shard: int) -> dict[str, np.ndarray]:
        """Memory maps of a shard, opened once per worker."""
        at = (self.uri, kind, shard)
        if at not in _maps:
            f = Files(self.uri)
            gram = {"key": "<u8", "n": np.uint8, "bigkey": "<u8", "bign": "<i8"}
            spec = {"gram": gram, "hot": gram, "ctx": {"key": "<u8", "n": "<f8"}}.get(kind.rstrip("0123456789"), {"key": "<u8", "n": "<i8"})
            _maps[at] = {x: f.read(f"{kind}-{shard}.{x}", d) for x, d in spec.items()}
        return _maps[at]

    def lookup(self, kind: str, keys: np.ndarray, width: int, bits: int, columns: int = 1) -> np.ndarray:
        """The stored values of sorted keys of ``width`` bits; 0 where there is none."""
        out = np.zeros((len(keys), columns))
        for shard, s, e in _slices(keys >> np.uint64(width - bits)):
            t = self.table(kind, shard)
            if not len(t["key"]):
                continue
            at = np.minimum(np.searchsorted(t["key"], keys[s:e]), len(t["key"]) - 1)
            hit = t["key"][at] == keys[s:e]
            n = np.asarray(t["n"].reshape(-1, columns)[at], np.float64)
            if "bigkey" in t and len(t["bigkey"]):
                big = np.flatnonzero(n[:, 0] == 255)
                n[big, 0] = t["bign"][np.minimum(np.searchsorted(t["bigkey"], keys[s:e][big]), len(t["bign"]) - 1)]
            out[s:e] = np.where(hit[:, None], n, 0)
        return out

    def score(self, texts: list[str]) -> pd.DataFrame:
        """n_tokens, n_known, base_score, score (log10) of each text."""
        h, firsts = tokens(texts)
        lengths = np.diff(firsts)
        if not len(lengths):
            return pd.DataFrame({"n_tokens": [], "n_known": [], "base_score": [], "score": []})
        w48 = h >> np.uint64(16)

        u, inv = np.unique(h, return_inverse=True)
        c = self.lookup("word", u, 64, word_bits(self.bits))[:, 0]
        base = np.log10((c + 1) / (self.word.total + 1.0 * (self.word.types + 1)))

        d1 = self.next.discounts()
        total = max(1, self.next.total)
        x, inv48 = np.unique(w48, return_inverse=True)
        n = self.lookup("next", x, 48, word_bits(self.bits))[:, 0]
        more = self.next.types - self.next.n1 - self.next.n2
        rest = (d1[1] * self.next.n1 + d1[2] * self.next.n2 + d1[3] * more) / total if self.next.types else 1.0
        q = np.maximum(n - d1[np.minimum(n, 3).astype(int)], 0) / total + rest / (self.word.types + 1)

        p = q[inv48]
        for k, history in enumerate(histories(h, firsts, max(self.grams)), 2):
            v48, d = history >> np.uint64(16), self.grams[k].discounts()
            x, invctx = np.unique(v48, return_inverse=True)
            ctx = self.lookup(f"ctx{k}", x, 48, self.bits, 4)
            few, totals = self.hot[k]
            split = _among(x, few)
            ctx[split] = totals[np.searchsorted(few, x[split])]
            seen = ctx[:, 0] > 0
            gamma = np.where(seen, (ctx[:, 1:] @ d[1:]) / np.maximum(ctx[:, 0], 1), 1.0)
            heavy = split[invctx]
            n = np.zeros(len(v48))
            for kind, key, at in (("gram", pair_key, np.flatnonzero(~heavy)), ("hot", spread_key, np.flatnonzero(heavy))):
                x, invgram = np.unique(key(v48[at], w48[at]), return_inverse=True)
                n[at] = self.lookup(f"{kind}{k}", x, 64, self.bits)[invgram, 0]
            top = np.maximum(n - d[np.minimum(n, 3).astype(int)], 0)
            p = top / np.maximum(ctx[:, 0], 1)[invctx] * seen[invctx] + gamma[invctx] * p
        return pd.DataFrame({
            "n_tokens": lengths, "n_known": np.add.reduceat((c > 0)[inv].astype(np.int64), firsts[:-1]),
            "base_score": np.add.reduceat(base[inv], firsts[:-1]),
            "score": np.add.reduceat(np.log10(np.maximum(p, 1e-300)), firsts[:-1])})


_maps: dict[tuple, dict[str, np.ndarray]] = {}


def train(docs: DataFrame, order: int = ORDER) -> Model:
    """The model of all texts of ``docs`` (null as empty); its files lie in the shared folder."""
    spark = docs.sparkSession
    small_batches(spark, 500)
    uri = shared_path(spark, "lm")
    bits = min(16, max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()))

    texts = docs.select(text_or_empty("text").alias("text"))
    hot = hot_contexts(texts, bits, order)

    def merge(blobs):
        shards = blobs.repartition("kind", "shard").sortWithinPartitions("kind", "shard")
        return store(shards.mapInArrow(_merge(uri, bits, hot), BLOBS), "lm")

    steps = [merge(texts.mapInArrow(_sum_tokens(bits, order, hot), BLOBS))]
    for k in range(order - 1, 1, -1):
        steps.append(merge(steps[-1].where(F.col("kind").isin(f"gram{k}", f"hot{k}"))))
    steps.append(merge(steps[-1].where(F.col("kind") == "next")))
    stats, totals = {}, {}
    for step in steps:
        for r in step.where("kind LIKE '% stat'").select("kind", "a").collect():  # one row a shard
            stats[r["kind"]] = stats.get(r["kind"], 0) + np.frombuffer(r["a"], "<i8")
    for step, k in zip(steps, range(order, 1, -1)):
        totals[k] = _hot_totals(step.where(F.col("kind") == f"ctx{k}"))
    drop(*steps)
    of = lambda k: Order(*map(int, stats.get(f"{k} stat", np.zeros(6, np.int64))))
    return Model(uri, bits, of("word"), of("next"), {k: of(f"gram{k}") for k in range(2, order + 1)}, totals)


def _hot_totals(parts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The hot contexts in order and their totals: the sums of their shards' parts."""
    def unpack(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                v = np.frombuffer(batch.column("a")[i].as_py(), "<u8").astype(np.int64)
                ctx = np.frombuffer(batch.column("b")[i].as_py(), "<f8").reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(v), *[pa.array(x) for x in ctx.T.copy()]],
                                                 names=["v", "n", "n1", "n2", "n3"])

    rows = (parts.select("a", "b").mapInArrow(unpack, "v long, n double, n1 double, n2 double, n3 double")
            .groupBy("v").agg(*[F.sum(c) for c in ("n", "n1", "n2", "n3")]).collect())  # at most SPREAD * S
    rows.sort()
    return (np.array([r[0] for r in rows], np.uint64), np.array([r[1:] for r in rows], np.float64).reshape(-1, 4))


def score_documents(docs: DataFrame, folds: int = 7, held: int = 2, order: int = ORDER) -> DataFrame:
    """Learn from the rows outside the held-out fold, score all: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    Null and empty texts are their end token alone; a row without doc_id counts as training text; repeated rows
    count as often as they occur; other columns are ignored. Without training text every word is unknown.
    """
    small_batches(docs.sparkSession, 1000)
    held_out = F.pmod(doc_crc(), F.lit(folds)) == held
    model = train(docs.where(~held_out), order)

    @F.pandas_udf("struct<n_tokens:long,n_known:long,base_score:double,score:double>")
    def score(texts: pd.Series) -> pd.DataFrame:
        return model.score(texts.tolist())

    return (docs.select("doc_id", held_out.alias("held_out"), score(text_or_empty("text")).alias("s"))
            .select("doc_id", "held_out", "s.n_tokens", "s.n_known",
                    F.lit(model.word.total).cast("long").alias("train_tokens"), "s.base_score", "s.score"))
