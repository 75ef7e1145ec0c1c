"""Repeated passages: windows of words that start anywhere else are removed.

The references are the passages that may repeat, one representative document
each, and a document is streamed through the suffix automata of those references
alone with which it shares an anchor. Sending every automaton to every task, which
finds the same, costs references times documents.
"""

from __future__ import annotations

from collections import OrderedDict, defaultdict
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crispstar.llm.common import arrow_types, batched, in_arrow, raw, text_of
from crispstar.llm.suffix_automaton import Passage, Reference, SuffixAutomaton, spans
from crispstar.session import materialize

WINDOW, ANCHOR = 35, 10
_MOST = np.uint64((1 << 64) - 1)
# Words of automata kept by a task, and bytes of text hashed at once.
_HELD_WORDS, _BLOCK_BYTES = 200_000, 1 << 20
_BASE = 0x9E3779B97F4A7C15
_PASSAGES = "starts array<int>, texts array<binary>"
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base of the word hash and of its inverse, modulo 2**64."""
    if len(_known_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(max(n, _BLOCK_BYTES + 2), base, np.uint64)
            factors[0] = 1
            _known_powers[i] = np.multiply.accumulate(factors)
    return _known_powers[0][:n], _known_powers[1][:n]


_known_powers = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


class Words:
    """The words of some texts: where each begins and ends in all texts put together, and its hash.

    Equal words have equal hashes; different ones that had would only cost time, since
    hashes choose what automata of the words themselves are asked.
    """

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        space = _IS_SPACE[data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(data) and not space[0]:
            edge = np.r_[0, edge]
        self.begins, self.ends = edge[::2], edge[1::2]
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        # Of text i: words self.first[i] up to before self.first[i + 1]; self.offset[i] is where it begins.
        self.first, self.offset = np.searchsorted(self.begins, offsets), offsets[:-1]
        powers, inverse = _powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
        hashes = (sums[self.ends] - sums[self.begins]) * inverse[self.begins]
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        self.hashes = hashes ^ (hashes >> np.uint64(32))

    def cut(self, texts: list[bytes], i: int, a: int, b: int) -> bytes:
        """Words ``a`` up to before ``b`` of text ``i``, with the white space between them."""
        a, b = self.first[i] + a, min(self.first[i] + b, self.first[i + 1])
        return texts[i][self.begins[a] - self.offset[i] : self.ends[b - 1] - self.offset[i]]


def _rolled(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each ``size`` consecutive word hashes."""
    out = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for i in range(size):
        out = out * np.uint64(_BASE) + words[i : i + len(out)]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def _slid(x: np.ndarray, size: int, pick) -> np.ndarray:
    """Minimum or maximum over each ``size`` consecutive values."""
    done, out = 1, x
    while done < size:
        step = min(done, size - done)
        out = pick(out[: len(out) - step], out[step:])
        done += step
    return out


def anchors(words: Words, window: int = WINDOW, anchor: int = ANCHOR) -> list[tuple[np.ndarray, np.ndarray]]:
    """Positions and hashes of each text's anchors: in every window, its smallest ``anchor``-word hash.

    What is picked depends on the window alone, so equal windows hold equal anchors.
    """
    first, ends = words.first[:-1], words.first[1:]
    if len(words.hashes) < window:
        return [(np.zeros(0, np.int64), np.zeros(0, np.uint64)) for _ in ends]
    grams, reach = _rolled(words.hashes, anchor), window - anchor + 1
    for e in ends[:-1]:
        grams[max(0, e - anchor + 1) : e] = _MOST  # over the end of a text
    least = _slid(grams, reach, np.minimum)
    least[~_within(words, window)] = 0
    padded = np.concatenate([np.zeros(reach - 1, np.uint64), least, np.zeros(reach - 1, np.uint64)])
    picked = np.flatnonzero(_slid(padded, reach, np.maximum) == grams)
    cuts = np.searchsorted(picked, words.first)
    return [(picked[a:b] - s, grams[picked[a:b]]) for a, b, s in zip(cuts, cuts[1:], first)]


def _within(words: Words, size: int) -> np.ndarray:
    """For each ``size`` consecutive words of all texts, whether they are of one text."""
    out = np.zeros(max(0, len(words.hashes) - size + 1), bool)
    for a, b in zip(words.first, words.first[1:]):
        out[a : max(a, b - size + 1)] = True
    return out


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about a block's size, with the number of the first."""
    first, held, n = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text)
        n += len(text)
        if n >= _BLOCK_BYTES:
            yield first, held
            first, held, n = i + 1, [], 0
    if held:
        yield first, held


def _signed(x: np.ndarray) -> list[int]:
    return x.view(np.int64).tolist()


def _keys(values: list[np.ndarray], of: list[int]) -> pa.RecordBatch:
    """``v, of, n``: each document's distinct hashes and how often it has them."""
    counted = [np.unique(x, return_counts=True) for x in values]
    v, n = (np.concatenate([c[i] for c in counted]) for i in (0, 1))
    repeated = np.repeat(np.array(of, np.int64), [len(c[0]) for c in counted])
    return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(repeated), pa.array(n.astype(np.int32))], names=["v", "of", "n"])


def _anchor_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        routes = batch.column("route").to_pylist()
        for first, texts in _blocks(raw(batch, "text")):
            yield _keys([values for _, values in anchors(Words(texts))], routes[first : first + len(texts)])


def _asked(texts: list[bytes], hits: list[dict[int, int]], window: int, anchor: int) -> Iterator[list[dict]]:
    """Passages of each document for the references that it shares anchors with, itself included."""
    words = Words(texts)
    for i, ((at, values), to) in enumerate(zip(anchors(words, window, anchor), hits)):
        near = defaultdict(list)
        for position, value in zip(at.tolist(), _signed(values)):
            if value in to:
                near[to[value]].append(max(0, position + anchor - window))
        # From the first word of the first window with the anchor to the last word of the last.
        found = {ref: spans(starts, 2 * window - anchor) for ref, starts in near.items()}
        yield [
            {"to": ref, "starts": [a for a, _ in todo], "texts": [words.cut(texts, i, a, b) for a, b in todo]}
            for ref, todo in found.items()
        ]


def _read(starts: list[int], texts: list[bytes]) -> list[Passage]:
    return [(a, t.split()) for a, t in zip(starts, texts)]


def _matched(window: int):
    """``p, starts, ends, rest_starts, rest_texts``: repeated stretches, and passages with windows that its reference lacks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: OrderedDict[int, tuple[Reference, int]] = OrderedDict()
        size = 0

        def closed(ref_p: int) -> tuple:
            return _result(ref_p, held[ref_p][0].repeated(), window)

        for batch in batches:
            refs = batch.column("ref_p").to_pylist()
            for i, ref_p in enumerate(refs):
                if ref_p not in held:
                    passages = _read(batch.column("ref_starts")[i].as_py(), batch.column("ref_texts")[i].as_py())
                    held[ref_p] = (Reference(passages, window), sum(len(w) for _, w in passages))
                    size += held[ref_p][1]
                    while size > _HELD_WORDS and len(held) > 1:
                        oldest = next(iter(held))
                        yield closed(oldest)
                        size -= held.pop(oldest)[1]
                held.move_to_end(ref_p)
                p = batch.column("p")[i].as_py()
                if p == ref_p:
                    continue
                starts, texts = batch.column("starts")[i].as_py(), batch.column("texts")[i].as_py()
                found, rest = held[ref_p][0].match(starts, texts)
                yield (*_result(p, found, window)[:3], *rest)
        yield from map(closed, held)

    return rows


def _result(p: int, starts: list[int], window: int) -> tuple:
    found = spans(starts, window)
    return p, [a for a, _ in found], [b for _, b in found], [], []


_RESULT = "p long, starts array<int>, ends array<int>, rest_starts array<int>, rest_texts array<binary>"


def _match(asked: DataFrame, window: int, label: str) -> DataFrame:
    """Stream the passages that ask for a reference through its automaton; a reference asks for its ``own`` passages."""
    # Rows that share a route, being equal, all ask for their own passages; one is the reference, the others ask it like any copy.
    first = asked.filter("own").groupBy("to").agg(F.min_by(F.struct("p", "starts", "texts"), "p").alias("ref"))
    refs = first.select("to", F.col("ref.p").alias("ref_p"), F.col("ref.starts").alias("ref_starts"), F.col("ref.texts").alias("ref_texts"))
    # Sorted by reference, so that a task builds each automaton once; a hot reference can be split over tasks.
    pairs = asked.join(refs.hint("merge"), "to").select("p", "starts", "texts", "ref_p", "ref_starts", "ref_texts")
    names, types = arrow_types(asked, _RESULT)
    run = _matched(window)
    return materialize(pairs.mapInArrow(lambda it: batched(run(it), names, types, 2000), _RESULT), label)


def _hits(keys: DataFrame) -> DataFrame:
    """For each document ``of``: its keys ``v`` found more than once, with the smallest ``of`` that has them."""
    repeated = keys.groupBy("v").agg(F.sum("n").alias("total"), F.min("of").alias("to")).filter(F.col("total") > 1)
    # Written, so that both sides of the join are plain exchanges, which can be split at a hot key.
    found = materialize(repeated.select("v", "to"), "repeated")
    return keys.join(found, "v").groupBy("of").agg(F.collect_set(F.struct("v", "to")).alias("hits"))


def _merged(pieces: list[dict], window: int) -> list[Passage]:
    """Passages of one document that may overlap, as passages that do not."""
    words, covered = {}, []
    for piece in pieces:
        for at, text in zip(piece["rest_starts"], piece["rest_texts"]):
            found = text.split()
            words.update(enumerate(found, at))
            covered += range(at, at + len(found) - window + 1)
    return [(a, [words[i] for i in range(a, b)]) for a, b in spans(set(covered), window)]


def _second_round(first: DataFrame, window: int) -> DataFrame:
    """Windows whose representative lacked them: now each window is its own anchor."""
    left = first.filter(F.size("rest_starts") > 0).groupBy("p").agg(F.collect_list(F.struct("rest_starts", "rest_texts")).alias("pieces"))

    def merged(batch: pa.RecordBatch) -> Iterable[tuple]:
        for p, pieces in zip(batch.column("p").to_pylist(), batch.column("pieces").to_pylist()):
            passages = _merged(pieces, window)
            yield p, [a for a, _ in passages], [b" ".join(w) for _, w in passages]

    rest = materialize(in_arrow(left, merged, f"p long, {_PASSAGES}", 2000), "unmatched")

    def hashed(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
        """Document, first word, text and window hashes of each passage."""
        every = [(p, a, t) for p, at, ts in zip(*(batch.column(c).to_pylist() for c in ("p", "starts", "texts"))) for a, t in zip(at, ts)]
        for first, texts in _blocks([t for _, _, t in every]):
            words = Words(texts)
            rolled = _rolled(words.hashes, window)
            for i, (a, b) in enumerate(zip(words.first, words.first[1:])):
                yield *every[first + i][:2], texts[i], rolled[a : max(a, b - window + 1)]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = defaultdict(list)
            for p, _, _, values in hashed(batch):
                of[p].append(values)
            if of:
                yield _keys([np.concatenate(x) for x in of.values()], list(of))

    hits = _hits(rest.mapInArrow(keys, "v long, of long, n int"))

    def asked(batch: pa.RecordBatch) -> Iterable[tuple]:
        to = {p: {h["v"]: h["to"] for h in hs} for p, hs in zip(batch.column("p").to_pylist(), batch.column("hits").to_pylist())}
        near: dict[tuple[int, int], list[tuple[int, list[bytes]]]] = defaultdict(list)
        for p, at, text, values in hashed(batch):
            found = [(i, to[p][v]) for i, v in enumerate(_signed(values)) if v in to[p]]
            words = text.split() if found else []
            for i, ref in found:
                near[ref, p].append((at + i, words[i : i + window]))
        for (ref, p), windows in near.items():
            text = {at + i: w for at, ws in windows for i, w in enumerate(ws)}
            todo = spans([at for at, _ in windows], window)
            yield ref, p, ref == p, [a for a, _ in todo], [b" ".join([text[i] for i in range(a, b)]) for a, b in todo]

    joined = rest.join(hits, rest["p"] == hits["of"]).drop("of")
    found = in_arrow(joined, asked, f"to long, p long, own boolean, {_PASSAGES}", 2000)
    return _match(materialize(found, "asked-rest"), window, "matched-rest")


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """Every row with the stretches of words to remove: ``id, n_words, all_sha256, text, marks``.

    ``marks`` holds stretches from ``starts`` up to before ``ends``, which may overlap.
    It is NULL where nothing is removed, and ``text`` where no anchor is shared with
    anything; ``all_sha256`` is of all words.
    """
    text = text_of(text_col)
    # Routes a row to what concerns it. Short documents come first and so become the
    # representatives; rows with one route are equal and have one reference.
    route = F.shiftleft(F.least(F.octet_length(text), F.lit((1 << 23) - 1)).cast("long"), 40).bitwiseOR(
        F.xxhash64(F.col(id_col), text).bitwiseAND(F.lit((1 << 40) - 1))
    )
    routed = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), route.alias("route"))
    found = materialize(routed.select("route", "text").mapInArrow(_anchor_keys, "v long, of long, n int"), "anchors")
    hits = _hits(found)

    def rows(batch: pa.RecordBatch) -> Iterable[tuple]:
        ids, routes, hits = (batch.column(c).to_pylist() for c in ("id", "route", "hits"))
        for first, texts in _blocks(raw(batch, "text")):
            here = range(first, first + len(texts))
            some = [(t, {h["v"]: h["to"] for h in hits[i]}) for i, t in zip(here, texts) if hits[i]]
            asked = iter(_asked([t for t, _ in some], [h for _, h in some], window, anchor)) if some else iter(())
            for i, text in zip(here, texts):
                words = text.split()
                whole = sha256(b" ".join(words)).hexdigest()
                yield ids[i], routes[i], len(words), whole, next(asked) if hits[i] else None, text if hits[i] else None

    schema = (
        "id long, route long, n_words long, all_sha256 string,"
        " asked array<struct<to: long, starts: array<int>, texts: array<binary>>>, text binary"
    )
    joined = routed.join(hits, routed["route"] == hits["of"], "left").select("id", "route", "text", "hits")
    rows_ = materialize(in_arrow(joined, rows, schema, 2000).withColumn("p", F.monotonically_increasing_id()), "candidates")
    asked = rows_.select("p", "route", F.explode("asked").alias("ask")).select(
        "ask.to", "p", (F.col("ask.to") == F.col("route")).alias("own"), "ask.starts", "ask.texts"
    )
    first = _match(asked, window, "matched")
    second = _second_round(first, window)
    both = first.select("p", "starts", "ends").unionByName(second.select("p", "starts", "ends"))
    marks = both.filter(F.size("starts") > 0).groupBy("p").agg(F.collect_list(F.struct("starts", "ends")).alias("marks"))
    plain = rows_.filter(F.col("asked").isNull()).select("id", "n_words", "all_sha256").withColumns(
        {"text": F.lit(None).cast("binary"), "marks": F.lit(None).cast(marks.schema["marks"].dataType)}
    )
    marked = rows_.filter(F.col("asked").isNotNull()).join(marks, "p", "left").select("id", "n_words", "all_sha256", "text", "marks")
    return marked.unionByName(plain).withColumnRenamed("id", id_col)


def _removed(marks: list[dict] | None) -> list[tuple[int, int]]:
    stretches = sorted((a, b) for m in marks or [] for a, b in zip(m["starts"], m["ends"]))
    out: list[tuple[int, int]] = []
    for a, b in stretches:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: ``id, n_words, n_removed, kept_sha256``.

    Words are runs of other characters than the six ASCII spaces. A word is removed
    if a window of ``window`` consecutive words of its document covers it whose words
    also start anywhere else, in the same document too, as the texts are given. The
    digest is of the kept words, joined by one space.

    NULL and empty texts have no words; shorter texts have no window and stay. Rows
    that repeat, or share or lack an id, are documents of their own.
    """
    found = repeated_spans(docs, id_col, text_col, window)

    def rows(batch: pa.RecordBatch) -> Iterable[tuple]:
        columns = (batch.column(c).to_pylist() for c in (id_col, "n_words", "all_sha256", "marks"))
        for i, n, all_sha, marks, text in zip(*columns, raw(batch, "text")):
            gone = _removed(marks)
            if not gone:
                yield i, n, 0, all_sha
                continue
            words, at, kept = text.split(), 0, []
            for a, b in gone:
                kept += words[at:a]
                at = b
            kept += words[at:]
            yield i, n, n - len(kept), sha256(b" ".join(kept)).hexdigest()

    return in_arrow(found, rows, f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string", 5000)


def remove_shared(
    docs: DataFrame, reference: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shard_words: int = _HELD_WORDS,
    reference_col: str = "text", most_bytes: int = 64 << 20,
) -> DataFrame:
    """Remove from each text what a given reference holds: the automata of its shards are broadcast.

    ``id, kept``: the words not covered by a window that occurs in the reference,
    joined by one space. For a reference of a checked size, such as a benchmark: beyond ``most_bytes`` of text it
    is refused, and ``remove_repeated`` over both tables is the way. NULL and empty texts hold nothing, nor does an empty
    reference; repeated rows are treated alike; other columns are ignored; an empty table gives no rows.
    """
    held = reference.select(F.col(reference_col).alias("text")).filter(F.col("text").isNotNull())
    size = held.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"a reference of {size} bytes is too large to be broadcast; {most_bytes} at most")
    shards: list[list[list[bytes]]] = [[]]
    for row in held.orderBy("text").collect():
        shards[-1].append(row["text"].encode().split())
        if sum(map(len, shards[-1])) >= shard_words:
            shards.append([])
    sent = [docs.sparkSession.sparkContext.broadcast(s) for s in shards if s]
    built: dict[int, SuffixAutomaton] = {}

    def rows(batch: pa.RecordBatch) -> Iterable[tuple]:
        texts = [t.split() for t in raw(batch, "text")]
        gone: list[set[int]] = [set() for _ in texts]
        for k, shard in enumerate(sent):
            if k not in built:
                built.clear()
                built[k] = SuffixAutomaton(shard.value)
            for words, out in zip(texts, gone):
                out.update(i for i, _ in built[k].windows(words, window))
        for i, words, out in zip(batch.column("id").to_pylist(), texts, gone):
            stretches, at, kept = spans(out, window), 0, []
            for a, b in stretches:
                kept += words[at:a]
                at = b
            yield i, b" ".join(kept + words[at:]).decode("utf-8", "replace")

    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return in_arrow(read, rows, "id long, kept string", 2000).withColumnRenamed("id", id_col)
