"""BPE encoding of whole texts by fragments between forced boundaries."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from hashlib import sha256
from operator import add, itemgetter
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from crispstar.llm.common import BoundedCache, in_arrow, raw, sliced

# Bytes of digests that a worker keeps; words and chunks have half as many each.
CACHED = 64 << 20
_SPACES = b" \t\n\v\f\r"
# Letters that stay what they are under every normal form, and marks that no contraction starts with.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!,.:;?]*)")
# Those letters with any printing ASCII, and the pieces that _LETTERS cuts them into once they are lower case.
_SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

# The normaliser and the word pattern for which _PLAIN and _SIMPLE are shorter ways.
_LOWER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_LETTERS = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else the next from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in prints else next(spare)) for b in range(256)]


class ForcedBoundaryEncoder:
    """Encodes as the tokenizer file says, fragment by fragment.

    A byte pair that occurs inside no token can never be merged over, so a cut
    between its bytes changes nothing: what stands on both sides is encoded
    alone and concatenated. White space stands in no token of such a vocabulary
    and cuts the raw text into chunks; within a chunk the normalised words are
    cut again. Each distinct chunk and fragment is encoded once per cache.
    A vocabulary with white space inside tokens gets whole texts as chunks.
    """

    def __init__(self, file: str, cached: int = CACHED):
        spec, library = json.loads(file), Tokenizer.from_str(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("plain BPE models only")
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.ids, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in {**self.ids, **self.special}.items()}
        # What a digest reads of each id: its decimal digits and its token.
        self.digits, self.names = {i: str(i).encode() for i in self.tokens}, {i: t.encode() for i, t in self.tokens.items()}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        rules = {"vocab": self.ids, "merges": merges, "unk_token": model.get("unk_token")}
        # One merger for fragments that end a word, one for the others.
        self.merger = {True: BPE(**rules, end_of_word_suffix=self.end or None), False: BPE(**rules)}
        self.letters = byte_letters()
        self.letter_of = {b: c for b, c in enumerate(self.letters) if chr(b) != c}
        self.inside = self._pairs_inside()
        at = {c: b for b, c in enumerate(self.letters)}
        self.spaces_cut = not any(at[p[0]] in _SPACES or at[p[1]] in _SPACES for p in self.inside)
        self.plain = spec.get("normalizer") == _LOWER and spec.get("pre_tokenizer") == _LETTERS
        held = lambda ids: 56 + 8 * len(ids)
        self.words, self.chunks = BoundedCache(self._word, held, cached // 2), BoundedCache(self._chunk, held, cached // 2)
        self.digests = BoundedCache(self._digest, lambda made: 190 + len(made[1]) + len(made[2]), cached)

    def _pairs_inside(self) -> set[str]:
        """Two letters side by side in any token, the suffix of word ends not counted."""
        plain = (t.removesuffix(self.end) if self.end else t for t in self.ids)
        return {t[i : i + 2] for t in plain for i in range(len(t) - 1) if t[i] in self.letters and t[i + 1] in self.letters}

    def cut(self, word: str) -> list[str]:
        """The fragments of a word between its forced boundaries."""
        if self.inside.issuperset(map(add, word, word[1:])):
            return [word]
        at = [0, *[i for i, p in enumerate(map(add, word, word[1:]), 1) if p not in self.inside], len(word)]
        return [word[a:b] for a, b in zip(at, at[1:])]

    def _word(self, word: str) -> tuple[int, ...]:
        """Ids of a word in byte letters: of its fragments, one after the other."""
        *inner, last = self.cut(word)
        ends = [t.id for t in self.merger[True].tokenize(last)]
        return (*[t.id for part in inner for t in self.merger[False].tokenize(part)], *ends) if inner else tuple(ends)

    def _lettered(self, piece: str) -> str:
        """A piece in byte letters; printing ASCII is its own."""
        return piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letter_of)

    def _chunk(self, chunk: bytes) -> tuple[int, ...]:
        text = chunk.decode("utf-8", "replace")
        if self.plain and (m := _PLAIN.fullmatch(text)):
            word, marks = m.groups()
            ids = self.words[self._lettered(word.lower())] if word else ()
            return ids + self.words[marks] if marks else ids
        found: list[int] = []
        if self.plain and _SIMPLE.fullmatch(text) and not any(t in text for t in self.special):
            for piece in _PIECES.findall(text.lower()):
                found += self.words[self._lettered(piece)]
            return tuple(found)
        for piece, token in self._specials(text):
            if self.normalizer:
                piece = self.normalizer.normalize_str(piece)
            for word, _ in self.pre_tokenizer.pre_tokenize_str(piece):
                found += self.words[word]
            if token is not None:
                found.append(token)
        return tuple(found)

    def _specials(self, text: str) -> Iterable[tuple[str, int | None]]:
        """Plain pieces of a chunk, each with the special token that follows it."""
        while True:
            first = min(((text.find(t), -len(t), t) for t in self.special if t in text), default=None)
            if first is None:
                yield text, None
                return
            at, less, token = first
            yield text[:at], self.special[token]
            text = text[at - less :]

    def split(self, text: bytes) -> list[bytes]:
        """Chunks of a text that are encoded independently."""
        return text.split() if self.spaces_cut else [text]

    def encode(self, text: bytes) -> list[int]:
        """Ids of a UTF-8 text, without special tokens at its ends."""
        chunks = self.chunks
        return [i for c in self.split(text) for i in chunks[c]]

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens joined by a space, as a tokenizer without a decoder gives them; special ones included."""
        return " ".join([self.tokens[i] for i in ids])

    def _digest(self, chunk: bytes) -> tuple[int, bytes, bytes]:
        ids, digits, names = self._chunk(chunk), self.digits, self.names
        return len(ids), b" ".join([digits[i] for i in ids]), b" ".join([names[i] for i in ids])

    def digest(self, text: bytes) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the ids in decimal and of the decoded text."""
        chunks = self.split(text)
        if len(chunks) < 2:
            found = [self.digests[c] for c in chunks]
        else:
            found = itemgetter(*chunks)(self.digests)
        counts, ids, decoded = zip(*found) if found else ((), (), ())
        if 0 in counts:
            ids, decoded = filter(None, ids), filter(None, decoded)
        return sum(counts), sha256(b" ".join(ids)).hexdigest(), sha256(b" ".join(decoded)).hexdigest()


_loaded: dict[tuple[str, int], ForcedBoundaryEncoder] = {}


def encoder(file: str, cached: int = CACHED) -> ForcedBoundaryEncoder:
    """One encoder per Python worker, tokenizer file and size of its caches."""
    if (file, cached) not in _loaded:
        _loaded[file, cached] = ForcedBoundaryEncoder(file, cached)
    return _loaded[file, cached]


def read_tokenizer(path: str) -> str:
    """The tokenizer file, a few MB; the driver reads it, tasks get it broadcast."""
    return Path(path).read_text(encoding="utf-8")


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids``: the token ids of each whole text; NULL and empty texts have none."""
    file = docs.sparkSession.sparkContext.broadcast(read_tokenizer(path))

    def rows(batch: pa.RecordBatch) -> Iterable[tuple]:
        bpe = encoder(file.value)
        return ((i, bpe.encode(t)) for part in sliced(batch, "text") for i, t in zip(part.column("id").to_pylist(), raw(part, "text")))

    return in_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), rows, "id long, ids array<int>", 2000)


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """``id, text``: the decoded text of each row of ``encode_texts``."""
    file = encoded.sparkSession.sparkContext.broadcast(read_tokenizer(path))

    def rows(batch: pa.RecordBatch) -> Iterable[tuple]:
        bpe = encoder(file.value)
        return ((x["id"], bpe.decode(x["ids"] or [])) for x in batch.select(["id", "ids"]).to_pylist())

    return in_arrow(encoded, rows, "id long, text string", 2000)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", cached: int = CACHED) -> DataFrame:
    """One row per document: ``id, n_tokens, ids_sha256, decoded_sha256``.

    The digests are of the ids in decimal joined by one space, and of what they
    decode to. Texts are encoded whole; NULL and empty texts have no tokens;
    repeated rows give repeated rows; other columns are ignored. A NULL id stays.
    A worker keeps ``cached`` bytes of digests and half as many of words: rare words make most of the work.
    """
    file = docs.sparkSession.sparkContext.broadcast(read_tokenizer(path))

    def rows(batch: pa.RecordBatch) -> Iterable[tuple]:
        bpe = encoder(file.value, cached)
        return ((i, *bpe.digest(t)) for part in sliced(batch, "text") for i, t in zip(part.column("id").to_pylist(), raw(part, "text")))

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return in_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), rows, schema).withColumnRenamed("id", id_col)
