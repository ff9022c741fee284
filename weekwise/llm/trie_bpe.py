"""BPE encoding and decoding by a prefix-sharing trie of words.

The BPE encoding of a prefix of a word is known from one token: the last
one.  What stands before it is the encoding of a shorter prefix.  A trie of
the distinct words therefore holds one state per node, the last token of the
path from the root, and a child's state follows from its ancestors': it is
the token that ends there and that no merge joins with the last token of the
prefix before it.  Each shared prefix is computed once.

The trie is walked depth-first: the words of a chunk are sorted, which is
that order, and a stack holds the states of the current path, so memory is
the words of a chunk and the length of one of them.  Chunks are independent;
there is no shuffle and nothing is gathered.  A task keeps the encodings of
words it has met, up to ``KEPT_WORDS``, and beyond that those of the last chunk.
They go when it ends: a Python worker lives on idle, and an executor may have
more of them than it runs tasks.

Encoding equals that of the tokenizers library with the same file and
``add_special_tokens=False``: special tokens written in a text count as such.
Decoding is its ``decode(ids, skip_special_tokens=False)``.

Defined cases: null and empty texts have no tokens and decode to "".
"""

from __future__ import annotations

import json
import pickle
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekwise.llm.text_arrays import chunks, give_back

KEPT_WORDS = 300_000
KEPT_PAIRS = 500_000
SEGMENT = 1 << 18        # characters handled at once
NEVER = 1 << 60          # later than every merge

# White space, and the words of this tokenizer family.
WORD_SPACE = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"
SPACE = regex.compile(WORD_SPACE)
# split() also divides at these, which are no white space here
NO_SPACE = regex.compile("[\\x1c-\\x1f]")
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^ \p{L}\p{N}]+")
FAMILY = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


def visible_bytes() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    out.update({b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in out)})
    return out


class BpeTable:
    """Vocabulary and merges of a tokenizer file with word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        for part, known in FAMILY.items():
            if spec[part] != known:
                raise ValueError(f"the file's {part} is not the one this encoder reproduces")
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or spec.get("decoder"):
            raise ValueError("a BPE file without prefix and decoder is asked for")
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            made, left, right = self.ids[a + b], self.ids[a], self.ids[b]
            if made in self.halves:
                raise ValueError("two merges make one token")
            self.halves[made], self.rank[made] = (left, right), rank
            self.joined[left, right] = rank
        # a token that merges of its own bytes do not lead to never occurs
        self.reached = {i: i not in self.halves for i in self.ids.values()}
        for made in sorted(self.halves, key=self.rank.get):
            left, right = self.halves[made]
            self.reached[made] = (self.reached[left] and self.reached[right]
                                  and self.apart(left, right, self.rank[made]))
        self.width = max(self.text) + 1
        self.inside = {t: i for t, i in self.ids.items() if self.reached[i] and not t.endswith(self.end)}
        self.at_end = {t[:-len(self.end)]: i for t, i in self.ids.items() if self.reached[i] and t.endswith(self.end)}
        self.lengths = [0] * self.width
        for tokens in (self.inside, self.at_end):
            for t, i in tokens.items():
                self.lengths[i] = len(t)
        self.longest = max(self.lengths)
        self.pairs: dict[int, bool] = {}   # which tokens stay apart, as far as asked

    def apart(self, left: int, right: int, until: int = NEVER) -> bool:
        """Whether no merge ranked before ``until`` joins the two tokens' touching parts.

        The parts that touch are followed back in time, the younger one
        undone first.  A merge across would have come when its rank is below
        that at which either part was used up; among equal ranks the left
        one comes first.
        """
        rank, halves, joined = self.rank, self.halves, self.joined
        x, y, x_until, y_until = left, right, until, until
        while True:
            across = joined.get((x, y))
            if across is not None and across < x_until and (across < y_until or across == y_until != until):
                return False
            x_born, y_born = rank.get(x, -1), rank.get(y, -1)
            if x_born == y_born == -1:
                return True
            if x_born > y_born:
                x, x_until = halves[x][1], x_born
            else:
                y, y_until = halves[y][0], y_born


class TrieEncoder:
    """Encodings of words, as little-endian 32-bit ids."""

    def __init__(self, bpe: BpeTable) -> None:
        self.bpe = bpe
        self.shown = visible_bytes()
        self.packed = [i.to_bytes(4, "little") for i in range(bpe.width)]
        self.known: dict[str, bytes] = {}

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words that are not known yet, in one walk of their trie."""
        new = {w for w in words if w not in self.known}
        shown = self.shown
        spelled = sorted([(w if w.isascii() and w.isalnum() else
                           w.encode("utf-8", "surrogatepass").decode("latin-1").translate(shown), w) for w in new])
        bpe = self.bpe
        inside, at_end, apart, pairs, longest = bpe.inside, bpe.at_end, bpe.apart, bpe.pairs, bpe.longest
        width, lengths, packed = bpe.width, bpe.lengths, self.packed
        if len(pairs) > KEPT_PAIRS:
            pairs.clear()
        state: list[int] = [-1]            # last token of the path at each depth
        path = ""
        for text, word in spelled:
            inner = len(text) - 1
            shared, top = 0, min(len(state) - 1, inner)
            while shared < top and path[shared] == text[shared]:
                shared += 1
            del state[shared + 1:]
            for depth in range(shared + 1, inner + 2):
                tokens = inside if depth <= inner else at_end
                # the longest token that ends here and stays apart from what is before it
                for start in range(depth - longest if depth > longest else 0, depth):
                    token = tokens.get(text[start:depth])
                    if token is None:
                        continue
                    if start == 0:
                        break
                    pair = state[start] * width + token
                    follows = pairs.get(pair)
                    if follows is None:
                        follows = pairs[pair] = apart(state[start], token)
                    if follows:
                        break
                else:
                    raise ValueError(f"the vocabulary has no token for {text[depth - 1]!r}")
                state.append(token)
            path = text
            encoded, depth = b"", inner + 1
            while depth:
                token = state[depth]
                encoded = packed[token] + encoded
                depth -= lengths[token]
            state.pop()                    # the last token ends the word: no prefix of others
            self.known[word] = encoded


def segments(text: str) -> Iterator[str]:
    """The text in pieces cut before a blank, which no word crosses."""
    start = 0
    while len(text) - start > SEGMENT:
        cut = SPACE.search(text, start + SEGMENT)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def blank_divided(text: str) -> list[str]:
    """The text in NFC and lower case, divided at white space."""
    if not text.isascii():
        # a capital sigma is lowered without regard to its place in the word
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    text = text.lower()
    return SPACE.split(text) if NO_SPACE.search(text) else text.split()


def token_texts(bpe: BpeTable) -> list[str]:
    """The text of every id."""
    out = [""] * bpe.width
    for i, t in bpe.text.items():
        out[i] = t
    return out


def decode_ids(ids: bytes, texts: list[str]) -> str:
    """The tokens' text, as the library gives it for a file without decoder."""
    return " ".join([texts[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, bpe: BpeTable) -> None:
        self.bpe = bpe
        self.trie = TrieEncoder(bpe)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(bpe.special, key=len, reverse=True))) + ")")
        self.special_ids = {t: np.array([i], dtype="<u4").tobytes() for t, i in bpe.special.items()}
        self.token_text = token_texts(bpe)

    def _parts(self, text: str) -> Iterator[list[str] | bytes]:
        for k, part in enumerate(self.special.split(text) if "<|" in text else [text]):
            if k % 2:
                yield self.special_ids[part]
            elif part:
                for piece in segments(part):
                    yield blank_divided(piece)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers.

        What stands between blanks is looked up as a whole; only what is new
        is divided into words.
        """
        parted = [list(self._parts(t)) for t in texts]
        met: set[str] = set()
        for parts in parted:
            for part in parts:
                if isinstance(part, list):
                    met.update(part)
        known = self.trie.known
        if len(known) + len(met) > KEPT_WORDS:
            known = self.trie.known = {x: known[x] for x in met if x in known}
        new = [x for x in met if x not in known]
        mixed = {x: WORD.findall(x) for x in new if not x.isalpha()}
        self.trie.learn({x for x in new if x.isalpha()}.union(*mixed.values()))
        for x, words in mixed.items():
            if len(words) != 1 or words[0] != x:
                known[x] = b"".join([known[w] for w in words])
        find = known.__getitem__
        return [b"".join([p if isinstance(p, bytes) else b"".join(map(find, p)) for p in parts])
                for parts in parted]

    def decode(self, ids: bytes) -> str:
        return decode_ids(ids, self.token_text)


class PackedTable:
    """A table on its way to the workers, as bytes: only a running task holds its entries."""

    def __init__(self, spark: SparkSession, tokenizer: str) -> None:
        self.packed = spark.sparkContext.broadcast(pickle.dumps(BpeTable(tokenizer), pickle.HIGHEST_PROTOCOL))

    def handle(self, batches: Iterator[pa.RecordBatch], column: str, one) -> Iterator[pa.RecordBatch]:
        """``one(codec, batch)`` of each chunk, with a codec that lasts as long as the task."""
        codec = Codec(pickle.loads(self.packed.value))
        for batch in chunks(batches, column):
            yield one(codec, batch)
        del codec
        give_back()


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids): the ids of every text, little-endian 32-bit integers."""
    table = PackedTable(docs.sparkSession, tokenizer)

    def encoded(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"),
                                           "ids": pa.array(codec.encode(texts), pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return table.handle(batches, "text", encoded)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary")


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, text) from (doc_id, ids)."""
    texts = encoded.sparkSession.sparkContext.broadcast(token_texts(BpeTable(tokenizer)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "ids"):
            decoded = [decode_ids(x, texts.value) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": batch.column("ids"),
                                              "text": pa.array(decoded, pa.string())})

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, text string")


def encode_and_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, text): the ids of every text and what they decode to.

    One worker of a task does both, so a table's entries are held once.
    """
    table = PackedTable(docs.sparkSession, tokenizer)

    def coded(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = codec.encode([t or "" for t in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.binary()),
                                           "text": pa.array([codec.decode(x) for x in ids], pa.string())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return table.handle(batches, "text", coded)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary, text string")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text."""
    return encode_and_decode(docs, tokenizer).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
