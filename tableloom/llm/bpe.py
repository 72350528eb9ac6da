"""Exact byte-pair encoding by backtracking over longest matches, and decoding through an offset table.

The encoder takes at each position the longest token that an Aho-Corasick automaton finds there. A token may follow
another only if merging the text of the two by rank would give just these two; a pair that is not compatible makes the
encoder try the next shorter token, and if there is none, take back the last one. A position at which this
happened is marked dead and never visited again, so the work is linear in the text.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField

from tableloom.llm.common import held_by_worker, with_results

#: Pieces of text are encoded once and then looked up; the table starts anew when it holds so many pieces.
MEMO_PIECES = 400_000

# The split pattern of the vocabulary file.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""

#: The same split in the faster standard module, for texts whose characters both modules class alike.
QUICK_SPLIT = re.compile(r""" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+""")
UNLIKE = re.compile("[\x1c-\x1f²³¹¼½¾]|[^\x00-\u017f]")

# Code points that the regex module knows as letters or numbers and the tokenizer's Unicode version does not.
YOUNG = regex.compile(
    "[՘֋-֌࢏౜೜₏₝-₟꟎-꟏꟒꟔꟝꟢꟱꭬-꭭"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    "\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f]"
)


def byte_names() -> dict[str, int]:
    """The printable stand-in of each byte: itself where it prints, else the next free character from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file's content: the bytes of each token by id, the two tokens it merges, and its special strings."""

    tokens: list[bytes]
    parts: list[tuple[int, int]]
    special: dict[str, int]


def load_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file (on the driver; its size bounds what is sent to the tasks).

    The ids of merged tokens must follow the order of the merges, which makes an id its token's rank.
    """
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    names, ids = byte_names(), content["model"]["vocab"]
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    tokens = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for text, i in ids.items():
        tokens[i] = bytes(names[c] for c in text)
    for text, i in special.items():
        tokens[i] = text.encode()
    parts, last = [(i, i) for i in range(len(tokens))], -1
    for merge in content["model"]["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        made = ids[left + right]
        if made <= last:
            raise ValueError("ids of merged tokens do not follow the order of the merges")
        parts[made], last = (ids[left], ids[right]), made
    return Vocabulary(tokens, parts, special)


class Encoder:
    """Encodes pieces of text; made once in each task."""

    def __init__(self, vocabulary: Vocabulary):
        self.parts = vocabulary.parts
        self.merged = {pair: i for i, pair in enumerate(vocabulary.parts) if pair[0] != i}
        plain = {t: i for i, t in enumerate(vocabulary.tokens) if t and i not in vocabulary.special.values()}
        self.length = [len(t) for t in vocabulary.tokens]
        self.shorter = [-1] * len(vocabulary.tokens)
        self.matches = ahocorasick.Automaton()
        for t, i in plain.items():
            self.matches.add_word(t.decode("latin-1"), i)
            self.shorter[i] = next((plain[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in plain), -1)
        self.matches.make_automaton()
        self.known: dict[tuple[int, int], bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging by rank leaves the border between the two tokens: no merge across it comes before those inside.

        The border's neighbours are taken apart in the reverse order of their merges; at each step the two tokens that
        then touch the border must not merge earlier than the merges undone so far.
        """
        pair = (a, b)
        found = self.known.get(pair)
        if found is None:
            if len(self.known) > MEMO_PIECES:
                self.known.clear()
            found = self.known[pair] = self._compatible(a, b)
        return found

    def _compatible(self, a: int, b: int) -> bool:
        parts, merged, undone = self.parts, self.merged, len(self.length) + 1
        while True:
            if merged.get((a, b), undone) < undone:
                return False
            if a > b:  # the left token was made last
                undone, a = a, parts[a][1]
                if a != undone:
                    continue
            # of two tokens with one rank the left one merges first, hence the right one is undone first
            if parts[b][0] != b:
                undone, b = b + 1, parts[b][0]
            elif parts[a][0] != a:
                undone, a = a, parts[a][1]
            else:
                return True

    def encode(self, piece: bytes) -> list[int]:
        text, length, shorter = piece.decode("latin-1"), self.length, self.shorter
        longest = [0] * (len(text) + 1)
        for end, token in self.matches.iter(text):
            longest[end - length[token] + 1] = token
        out: list[int] = []
        dead = bytearray(len(text) + 1)
        at, token = 0, longest[0]
        while at < len(text):
            end = at + length[token]
            if not dead[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at, token = end, longest[end]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
        return out


class Pieces(dict):
    """The ids of each piece seen lately, as bytes."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encoder.encode(piece.encode()), "<u4").tobytes()
        if len(self) >= MEMO_PIECES:
            self.clear()
        if len(piece) < 200:
            self[piece] = ids
        return ids


class Codec:
    """Encoder, decoder and splitter of a vocabulary, made once in each worker process and used by all its tasks."""

    def __init__(self, vocabulary: Vocabulary):
        self.pieces, self.decoder, self.parts = Pieces(Encoder(vocabulary)), Decoder(vocabulary), splitter(vocabulary)

    @staticmethod
    def of(key: str, sent) -> Codec:
        return held_by_worker(key, lambda: Codec(sent.value))

    def encode(self, text: str) -> bytes:
        return b"".join(
            b"".join(map(self.pieces.__getitem__, part)) if mark is None else mark.to_bytes(4, "little")
            for part, mark in self.parts(text)
        )

    def decode(self, ids: bytes) -> str:
        return self.decoder.decode(np.frombuffer(ids, "<u4").astype(np.int64)).decode("utf-8", "replace")


class Decoder:
    """All tokens in one run of bytes, with the offset at which each starts."""

    def __init__(self, vocabulary: Vocabulary):
        self.data = np.frombuffer(b"".join(vocabulary.tokens), np.uint8)
        self.offsets = np.zeros(len(vocabulary.tokens) + 1, np.int64)
        np.cumsum([len(t) for t in vocabulary.tokens], out=self.offsets[1:])

    def decode(self, ids: np.ndarray) -> bytes:
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        at = np.repeat(starts - ends + sizes, sizes)
        at += np.arange(len(at))
        return self.data[at].tobytes()


def splitter(vocabulary: Vocabulary):
    """A function that gives the pieces of a text, special strings apart: (piece, id or None)."""
    split = regex.compile(SPLIT)
    marks = sorted(vocabulary.special, key=len, reverse=True)
    special = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None

    def plain(text: str) -> list[str]:
        if not UNLIKE.search(text):
            return QUICK_SPLIT.findall(text)
        if YOUNG.search(text):
            return [text[slice(*m.span())] for m in split.finditer(YOUNG.sub("", text))]
        return split.findall(text)

    def parts(text: str):
        if special is None or not any(m in text for m in marks):
            yield plain(text), None
            return
        for i, part in enumerate(special.split(text)):
            if i % 2:
                yield [], vocabulary.special[part]
            elif part:
                yield plain(part), None

    return parts


def encode_decode(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row's token ids and the text decoded from them, as ``ids`` (little-endian 32-bit), ``n_tokens``, ``decoded``
    and the digests ``ids_sha256`` and ``decoded_sha256``, beside the row's own columns in ``row``.

    Null and empty texts have no ids; rows are independent, so repeated rows give equal results and an empty table
    an empty one. ``path`` names the vocabulary file on the driver.
    """
    vocabulary = load_vocabulary(path)
    key = hashlib.sha256(repr((vocabulary.tokens, vocabulary.parts, vocabulary.special)).encode()).hexdigest()
    sent = df.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        codec = Codec.of(key, sent)

        def work(texts: pa.Array) -> list[pa.Array]:
            ids, counts, ids_sha, decoded, decoded_sha = [], [], [], [], []
            for value in texts.to_pylist():
                found = codec.encode(value or "")
                back = codec.decode(found)
                ids.append(found)
                counts.append(len(found) // 4)
                ids_sha.append(hashlib.sha256(found).hexdigest())
                decoded.append(back)
                decoded_sha.append(hashlib.sha256(back.encode()).hexdigest())
            return [pa.array(ids, pa.binary()), pa.array(counts, pa.int64()), pa.array(decoded, pa.string()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]

        return work

    fields = [
        StructField("ids", BinaryType()), StructField("n_tokens", LongType()), StructField("decoded", StringType()),
        StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType()),
    ]
    return with_results(df, text, fields, make, keep)
