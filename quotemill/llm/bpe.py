"""BPE encoding and decoding with content-defined chunk reuse (operator 4).

A rolling hash cuts texts into chunks at places that depend on the characters around
them alone, so a passage that many documents share is cut alike in all.
Chunks that occur more than once are encoded once, in a table of their own; the others
where they stand.  Every join of two chunks is tested by encoding the words
around it in one go: where that differs from the halves, the window is widened, and
chunks that never agree are joined and encoded as one.

Tokens of this vocabulary do not reach across ASCII blanks, so a chunk is encoded
word by word through a memo that a task keeps.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import WORD, batches, bloom_filter, ship, staged

#: Mean characters between hash cuts (a power of two) and width of the rolling hash.
MEAN_CHUNK, WIDTH = 1024, 16
#: Entries of a task's word memo; past it the memo starts anew.
MEMO = 400_000
BATCH_CHARS = 4_000_000

_M = 0x9E3779B97F4A7C15
_WORDS = re.compile(WORD)


def chunks(texts: list[str]) -> list[list[str]]:
    """Chunks of each text, on end equal to it; an empty text has none.

    A cut stands before the first ASCII blank after a place where the hash of the last
    ``WIDTH`` characters is 0 modulo the mean size.
    """
    joined = "".join(texts)
    if not joined:
        return [[] for _ in texts]
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    h = points.astype(np.uint64) * np.uint64(_M)
    h ^= h >> np.uint64(31)
    width, power = 1, _M
    while width < WIDTH:  # h becomes the hash of the last 2 * width characters
        older = h[:-width] * np.uint64(power)
        h[width:] += older
        width, power = 2 * width, power * power % 2**64
    h *= np.uint64(_M)
    hits = np.flatnonzero((h >> np.uint64(40)) % np.uint64(MEAN_CHUNK) == 0)
    blanks = np.flatnonzero((points == 32) | ((points >= 9) & (points <= 13)))
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    own = np.searchsorted(ends, hits, "right")
    hits, own = (x[hits - starts[own] >= WIDTH] for x in (hits, own))
    at = np.searchsorted(blanks, hits, "right")
    hits, own, at = (x[at < len(blanks)] for x in (hits, own, at))
    cut = blanks[at]
    inside = cut < ends[own]
    cut, own = cut[inside], own[inside]
    cut, once = np.unique(cut, return_index=True)
    own = own[once]
    first, last = np.searchsorted(own, np.arange(len(texts))), np.searchsorted(own, np.arange(len(texts)), "right")
    out = []
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        at = [a, *(c for c in cut[first[i]:last[i]].tolist() if a < c < b), b]
        out.append([joined[x:y] for x, y in zip(at, at[1:]) if y > x])
    return out


def digest(chunk: str) -> bytes:
    return hashlib.blake2b(chunk.encode("utf-8", "surrogatepass"), digest_size=16).digest()


class Codec:
    """A tokenizer with a memo of words."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation(), self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size()
        self.kind = np.uint16 if size <= 65536 else np.uint32
        self.tokens = [self.tokenizer.id_to_token(i).encode() for i in range(size)]
        self.decimal = [str(i).encode() for i in range(size)]
        self.memo: dict[str, bytes] = {}

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed."""
        words = [_WORDS.findall(t) for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = list({w for ws in words for w in ws if w not in self.memo})
        for i in range(0, len(new), 20_000):
            self.memo.update(zip(new[i:i + 20_000], self._plain(new[i:i + 20_000])))
        return [b"".join(map(self.memo.__getitem__, ws)) for ws in words]

    def joined(self, parts: list[str]) -> list[str]:
        """The chunks of one text after repair: those whose join does not agree become one."""
        out = parts[:1]
        for part in parts[1:]:
            if self._agrees(out[-1], part):
                out.append(part)
            else:
                out[-1] += part
        return out

    def _agrees(self, left: str, right: str) -> bool:
        """Whether the words around the join encode alike apart and in one go.

        Starts from one word a side; a window that differs is doubled, to the
        whole of both sides at last.
        """
        count = 1
        while True:
            a, b = _edge(left, -count), _edge(right, count)
            one, two, both = self._plain([a, b, a + b])
            if one + two == both:
                return True
            if a == left and b == right:
                return False
            count *= 2

    def decode(self, packed: bytes) -> bytes:
        """What the library's decode(ids, skip_special_tokens=False) gives, in UTF-8."""
        return b" ".join(map(self.tokens.__getitem__, np.frombuffer(packed, self.kind).tolist()))

    def ids_text(self, packed: bytes) -> bytes:
        return b" ".join(map(self.decimal.__getitem__, np.frombuffer(packed, self.kind).tolist()))


def _edge(text: str, count: int) -> str:
    """The first (or, if negative, last) words of a text, up to its end."""
    if count > 0:
        for i, m in enumerate(_WORDS.finditer(text)):
            if i == count - 1:
                return text[:m.end()]
        return text
    reach = -count * 32
    while reach < len(text):
        found = list(_WORDS.finditer(text, len(text) - reach))
        if len(found) > -count:  # the first of them may be cut short
            return text[found[count].start():]
        reach *= 2
    found = list(_WORDS.finditer(text))
    return text[found[count].start():] if len(found) >= -count else text


def _places(bits: int) -> list:
    """A digest's first two words of 32 bits are its places in the filter."""
    return [F.conv(F.substring(F.hex("digest"), 8 * i + 1, 8), 16, 10).cast("long") % bits for i in (0, 1)]


def definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


_RESULT = {
    "digest": ("n_tokens long, ids_sha256 string, decoded_sha256 string", lambda codec, packed: (
        len(packed) // np.dtype(codec.kind).itemsize, hashlib.sha256(codec.ids_text(packed)).hexdigest(),
        hashlib.sha256(codec.decode(packed)).hexdigest())),
    "tokens": ("n_tokens long, ids array<int>, decoded string", lambda codec, packed: (
        len(packed) // np.dtype(codec.kind).itemsize, np.frombuffer(packed, codec.kind).astype(np.int32),
        codec.decode(packed).decode("utf-8", "replace"))),
}


def encode(docs: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id",), result: str = "digest") -> DataFrame:
    """``keep`` columns of every row with the encoding of its whole text.

    ``tokenizer`` is the path of a definition the driver can read.  With ``result`` "digest" the
    columns are ``n_tokens, ids_sha256, decoded_sha256``, with "tokens" ``n_tokens, ids,
    decoded``.  Null texts count as empty: no ids, empty decoded text.  Special tokens
    written in a text become their ids, as the library does.  One row out per row in.

    Chunk texts that occur once stay in the task that read them; a shared chunk's text
    goes through one shuffle to be encoded once, and its ids come back to the documents that hold it.
    """
    spark = docs.sparkSession
    ship(spark)
    text = definition(tokenizer)
    shared_text = spark.sparkContext.broadcast(text)
    columns, make = _RESULT[result]
    names = [c.split()[0] for c in columns.split(", ")]
    kept = docs.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def digests(frames):
        for frame in batches(frames, BATCH_CHARS):
            found = [digest(c) for cs in chunks(frame["text"].fillna("").tolist()) for c in cs]
            yield pd.DataFrame({"digest": found})

    seen = docs.select("text").mapInPandas(digests, "digest binary").groupBy("digest").count().where("count > 1")
    shared = spark.sparkContext.broadcast(bloom_filter(staged(seen.select("digest"), "bpe-shared"), _places))

    def hits(codec_chunks):
        """For chunks of a batch: their digests, and which may be shared."""
        words, bits = shared.value
        found = [digest(c) for c in codec_chunks]
        if not found:
            return found, np.zeros(0, bool)
        known = np.ones(len(found), bool)
        places = np.frombuffer(b"".join(found), ">u4").reshape(-1, 4).astype(np.int64)
        for i in (0, 1):
            place = places[:, i] % bits
            known &= (words[place >> 5] >> (place & 31).astype(np.uint32)) & 1 == 1
        return found, known

    def shared_chunks(frames):
        for frame in batches(frames, BATCH_CHARS):
            flat = [c for cs in chunks(frame["text"].fillna("").tolist()) for c in cs]
            found, known = hits(flat)
            once = {d: c for d, c, k in zip(found, flat, known) if k}
            yield pd.DataFrame({"digest": list(once), "chunk": list(once.values())}, dtype=object)

    def encode_chunks(frames):
        codec = Codec(shared_text.value)
        for frame in batches(frames, BATCH_CHARS, "chunk"):
            yield pd.DataFrame({"digest": frame["digest"], "ids": codec.encode(frame["chunk"].tolist())})

    table = docs.select("text").mapInPandas(shared_chunks, "digest binary, chunk string").groupBy("digest").agg(
        F.any_value("chunk").alias("chunk")).mapInPandas(encode_chunks, "digest binary, ids binary")
    table = staged(table, "bpe-chunks")

    def by_document(frames):
        """Finished documents as result columns; others as one row a chunk."""
        codec = Codec(shared_text.value)
        for frame in batches(frames, BATCH_CHARS):
            cut = [codec.joined(cs) for cs in chunks(frame["text"].fillna("").tolist())]
            flat = [c for cs in cut for c in cs]
            found, known = hits(flat)
            ids = codec.encode([c for c, k in zip(flat, known) if not k])
            done, parts, at, local = [], [], 0, iter(ids)
            for row, cs in enumerate(cut):
                here = range(at, at + len(cs))
                at += len(cs)
                packed = [None if known[i] else next(local) for i in here]
                if None not in packed:
                    done.append((row, -1, None, None, *make(codec, b"".join(packed))))
                else:
                    parts += [(row, j, found[i] if p is None else None, p, *[None] * len(names))
                              for j, (i, p) in enumerate(zip(here, packed))]
            out = pd.DataFrame(done + parts, columns=["_at", "_seq", "_digest", "_ids", *names], dtype=object)
            base = frame[["_row", *keep]].iloc[out["_at"].astype(int)].reset_index(drop=True)
            yield pd.concat([base, out.drop(columns="_at")], axis=1)

    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *keep, "text")
    rows = staged(rows.mapInPandas(
        by_document, f"_row long, {fields}, _seq int, _digest binary, _ids binary, {columns}"), "bpe-documents")
    finished = rows.where("_seq < 0").select(*keep, *names)
    open_ = rows.where("_seq >= 0").drop(*names).join(
        table.select(F.col("digest").alias("_digest"), F.col("ids").alias("_found")), "_digest", "left")
    open_ = open_.select("_row", "_seq", *keep, F.coalesce("_ids", "_found").alias("_ids"))
    open_ = open_.repartition("_row").sortWithinPartitions("_row", "_seq")

    def assemble(frames):
        codec = Codec(shared_text.value)
        held, base, packed = None, None, []
        for frame in frames:
            out = []
            for row, ids, *own in zip(frame["_row"].tolist(), frame["_ids"], *[frame[c] for c in keep]):
                if row != held:
                    if held is not None:
                        out.append((*base, *make(codec, b"".join(packed))))
                    held, base, packed = row, own, []
                packed.append(ids)
            yield pd.DataFrame(out, columns=[*keep, *names], dtype=object)
        if held is not None:
            yield pd.DataFrame([(*base, *make(codec, b"".join(packed)))], columns=[*keep, *names], dtype=object)

    return finished.unionByName(open_.mapInPandas(assemble, f"{fields}, {columns}"))
