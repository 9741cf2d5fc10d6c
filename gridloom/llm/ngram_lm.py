"""Scores of a bigram language model held in an Elias-Fano trie.

Pairs of neighbours are shuffled twice: to their second word, where they are counted and meet its
probability, and to the section of their first word, where a task encodes them. A context with more
followers than a section holds is cut by ranges of followers. Texts are scored in rounds of bounded size: the distinct
pairs of a round travel to the tasks that hold their sections, which answer them as whole arrays, and the answers meet the
round again, where they are added up. No task holds more than a section or a round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import Sent, fold, stored, table
from gridloom.llm.elias_fano import FOLLOWER_BITS, Section, build_section, pack, unpack

FOLD, HELD_OUT = 7, 2
#: Every pair of neighbours is kept, however rare.
MIN_PAIRS = 1
DISCOUNT = 0.75
#: Trie entries of a section, bytes of a round (two hashes a token; a longer text is a round of its own).
SECTION_ENTRIES = 1_000_000
ROUND_BYTES = 16 << 20
SHORT = FOLLOWER_BITS // 8
#: Texts that are cut into words at once.
WORD_ROWS = 1_000

END = xxhash.xxh64_intdigest(b"\n")  # no word holds a line break


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-case words of all texts in one array, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    flat = split.flatten()
    ends = np.cumsum(pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    some = pc.greater(pc.binary_length(flat), 0)  # blanks at an end of a text leave an empty word there
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))]).astype(np.int64)
    return flat.filter(some), np.diff(before[ends], prepend=0)


def _rounds(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list[pa.Array], np.ndarray, np.ndarray, np.ndarray, int]]:
    """``(ids, lengths, tokens, words, end)`` of consecutive whole texts with at least ``most`` tokens, the last ones with fewer.

    ``words`` are the sorted hashes of the distinct words, ``tokens`` numbers in it; each text has its end token, whose number is ``end``.
    """

    def closed() -> tuple[list[pa.Array], np.ndarray, np.ndarray, np.ndarray, int]:
        coded = pa.concat_arrays(found).dictionary_encode()
        known = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
        words = np.append(np.array([END], np.uint64), np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known)))
        order = np.argsort(words)
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words), dtype=np.int32)
        own = np.concatenate(lengths)
        tokens = np.full(int(own.sum()), rank[0], np.int32)
        inner = np.ones(len(tokens), bool)
        inner[np.cumsum(own) - 1] = False
        tokens[inner] = rank[coded.indices.to_numpy() + 1]
        return ids, own, tokens, words[order], int(rank[0])

    ids, lengths, found, size = [], [], [], 0
    for batch in (whole.slice(i, WORD_ROWS) for whole in batches for i in range(0, whole.num_rows, WORD_ROWS)):
        named = batch.column("doc_id") if "doc_id" in batch.schema.names else None
        words, counts = _words(batch.column("text"))
        ends = np.cumsum(counts)  # of the words of each text
        sizes = np.cumsum(counts + 1)
        start = 0
        while start < batch.num_rows:
            done = int(sizes[start - 1]) if start else 0
            stop = min(int(np.searchsorted(sizes, done + most - size)) + 1, batch.num_rows)
            low = int(ends[start - 1]) if start else 0
            found.append(words.slice(low, int(ends[stop - 1]) - low))
            lengths.append(counts[start:stop] + 1)
            if named is not None:
                ids.append(named[start:stop])
            size += int(sizes[stop - 1]) - done
            start = stop
            if size >= most:
                whole = closed()
                ids, lengths, found, size = [], [], [], 0
                yield whole
                del whole
    if lengths:
        yield closed()


def _before(tokens: np.ndarray, end: int) -> np.ndarray:
    """The token before each token; the end token stands before a text."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[0] = end
    return before  # every text but the first follows the end token of the one before it


#: Spark removes the shuffle files of an execution at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, name: str) -> DataFrame:
    """:func:`stored`, without the shuffle files that led to it: a step's files are gone before the next one writes its own."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return stored(df.select("*"), name)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)


def count_words(train: DataFrame) -> DataFrame:
    """``h, c``: hash and count of every token."""

    def count(batches):
        for _, _, tokens, words, _ in _rounds(batches, PAIR_CHUNK):
            yield pa.RecordBatch.from_pydict({"h": words.view(np.int64), "c": np.bincount(tokens, minlength=len(words))})

    return train.select("text").mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


#: Tokens whose words or pairs a task combines before they are shuffled, bytes of them that it hands over at once.
PAIR_CHUNK = 1 << 21
SENT_BYTES = 4 << 20


def slice_of(word: np.ndarray, slices) -> np.ndarray:
    """Which of equal ranges of unsigned hashes holds a word, from its top 20 bits."""
    return ((word >> np.uint64(44)).astype(np.int64) * slices) >> 20


class Places:
    """Where the pairs of a word go: to a range of the hashes, or, for words seen ``entries`` times or more, to places of their own, by slices of the other word.

    There are at most N / ``entries`` such words, and at most 3 N / ``entries`` + 1 places.
    """

    def __init__(self, sections: int, rows: list[tuple[int, int]], entries: int):
        self.sections, self.entries = sections, entries
        hot = sorted((h & (1 << 64) - 1, n) for h, n in rows)
        self.words = np.array([h for h, _ in hot], dtype=np.uint64)
        self.counts = np.array([n for _, n in hot], dtype=np.int64)
        self.slices = -(-self.counts // entries)
        self.base = sections + np.cumsum(self.slices) - self.slices

    def of(self, word: np.ndarray, other: np.ndarray) -> np.ndarray:
        place = ((word >> np.uint64(33)).astype(np.int64) * self.sections) >> 31
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
            place = np.where(self.words[at] == word, self.base[at] + slice_of(other, self.slices[at]), place)
        return place

    def owner(self, place: int) -> int | None:
        """The number of the word whose own place this is."""
        return None if place < self.sections else int(np.searchsorted(self.base, place, side="right")) - 1


def _low_bytes(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bytes of each number."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).ravel()


def _from_low_bytes(raw: np.ndarray, width: int) -> np.ndarray:
    wide = np.zeros((len(raw) // width, 8), np.uint8)
    wide[:, :width] = raw.reshape(-1, width)
    return wide.view("<u8").ravel()


def _planes(values: np.ndarray) -> np.ndarray:
    """The bytes that the numbers need, all lowest ones first: planes of equal bytes compress."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return np.ascontiguousarray(_low_bytes(values, width).reshape(-1, width).T).ravel()


def _from_planes(raw: np.ndarray, n: int) -> np.ndarray:
    return _from_low_bytes(np.ascontiguousarray(raw.reshape(-1, n).T).ravel(), len(raw) // n) if n else np.zeros(0, np.uint64)


def _sealed(arrays: dict[str, np.ndarray]) -> bytes:
    """Packed and compressed, for a shuffle."""
    raw = pack(arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _opened(blob: pa.Buffer) -> dict[str, np.ndarray]:
    return unpack(pa.decompress(blob.slice(8), int.from_bytes(blob.slice(0, 8).to_pybytes(), "little"), "zstd"))


def _in_steps(arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The arrays with the sorted ``a`` as its first value and the differences, in the bytes that they need."""
    step = np.diff(arrays["a"])
    width = max(1, (int(step.max(initial=0)).bit_length() + 7) // 8)
    return {**arrays, "a": arrays["a"][:1], "width": np.array([width]), "steps": _low_bytes(step, width)}


def _from_steps(arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    step = _from_low_bytes(arrays["steps"], int(arrays["width"][0]))
    rest = {name: value for name, value in arrays.items() if name not in ("width", "steps")}
    return {**rest, "a": np.cumsum(np.concatenate([arrays["a"], step]), dtype=np.uint64)}


def _packed(place: np.ndarray, arrays: Callable[[np.ndarray], dict[str, np.ndarray]]) -> Iterator[tuple[int, bytes]]:
    """Each place with its packed ``arrays``, which are made from the positions that belong to it; their order is kept."""
    order = np.argsort(place, kind="stable")
    ends = np.flatnonzero(np.diff(place[order], append=-1)) + 1
    for i, j in zip([0, *ends[:-1]], ends):
        yield int(place[order[i]]), pack(arrays(order[i:j]))


def _dealt(place: np.ndarray, arrays: dict[str, np.ndarray], encode=dict) -> pd.DataFrame:
    """One packed row per place."""
    return pd.DataFrame(_packed(place, lambda at: encode({k: v[at] for k, v in arrays.items()})), columns=["place", "pairs"])


def _gathered(blobs, decode=dict) -> dict[str, np.ndarray]:
    parts = [decode(unpack(bytes(blob))) for blob in blobs]
    return {name: np.concatenate([part[name] for part in parts]) for name in parts[0]}


def _summed(first: np.ndarray, second: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal pairs once, sorted, with the sum of their counts."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return a[at], b[at], np.add.reduceat(counts[order], at)


def dealt_pairs(train: DataFrame, places: Places) -> DataFrame:
    """``place, pairs``: the pairs of neighbours of at least ``PAIR_CHUNK`` tokens, combined, packed and dealt by their second word."""
    sent = Sent(train.sparkSession, places)

    def combined(tokens: np.ndarray, words: np.ndarray, end: int) -> Iterator[pa.RecordBatch]:
        pairs, c = np.unique(tokens.astype(np.int64) * len(words) + _before(tokens, end), return_counts=True)
        b, a = (x.astype(np.int32) for x in np.divmod(pairs, len(words)))
        c = c.astype(np.int32)
        del pairs
        rows, size = [], 0
        for row in _packed(sent.value.of(words[b], words[a]), lambda at: {"b": words[b[at]], "a": words[a[at]], "c": c[at]}):
            rows.append(row)
            size += len(row[1])
            if size >= SENT_BYTES:
                yield pa.RecordBatch.from_pydict(dict(zip(("place", "pairs"), zip(*rows))))
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(("place", "pairs"), zip(*rows))))

    def deal(batches):
        for _, _, tokens, words, end in _rounds(batches, PAIR_CHUNK):
            yield from combined(tokens, words, end)

    return train.select("text").mapInArrow(deal, "place long, pairs binary")


def count_pairs(train: DataFrame) -> DataFrame:
    """``a, b, c``: every pair of neighbours and how often it is seen, as a table."""

    def rows(pdf):
        x = _gathered(pdf["pairs"])
        b, a, c = _summed(x["b"], x["a"], x["c"].astype(np.int64))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64), "c": c})

    return dealt_pairs(train, Places(1, [], 1)).groupBy("place").applyInPandas(rows, "a long, b long, c long")


def _bounds(section: int, sections: int) -> tuple[int, int]:
    """The range of a section: hashes whose top 31 bits fall into it."""
    first, end = (-(-(s << 31) // sections) << 33 for s in (section, section + 1))
    return first, end


def build_trie(train: DataFrame, entries: int = SECTION_ENTRIES) -> tuple[DataFrame, Places, int, int]:
    """``place, t, blob`` of the model, its places, the number N of training tokens and V of distinct ones.

    With P(w) = (c + 1) / (N + V + 1), a pair of count k after a word of count n has
    P(w | v) = (k - D) / n + r(v) P(w), where r(v) = D t / n is what the t different followers of v leave
    over; so the probabilities after every word add up to one. Stored are log10 r(v) and
    log10 ((k - D) / n / P(w)). Every token has one predecessor and one follower (the end token of
    the text before stands before a text), so n is the sum over the pairs of either side.

    The pairs go to the place of their second word, where its probability is known, and from
    there to that of their first word, where they are encoded. The followers of a word with places of its
    own are a section for each; there n is left out of the gains, and ``t`` of all its places gives r(v).
    """
    words = kept(count_words(train), "lm-words")
    facts = words.agg(F.sum("c"), F.count(F.lit(1))).first()
    total, distinct = facts[0] or 0, facts[1]
    hot = words.where(F.col("c") >= entries).collect() if total else []
    places = Places(max(1, -(-total // entries)), [(r["h"], r["c"]) for r in hot], entries)
    sent = Sent(train.sparkSession, places)

    def weigh(key, pdf):
        x = _gathered(pdf["pairs"])
        b, a, c = _summed(x["b"], x["a"], x["c"].astype(np.int64))
        owner = sent.value.owner(int(key[0]))
        if owner is None:
            _, at = np.unique(b, return_inverse=True)
            seen = np.bincount(at, c)[at]
        else:
            seen = sent.value.counts[owner]
        gain = np.log10(c - DISCOUNT) - np.log10((seen + 1) / (total + distinct + 1))
        order = np.argsort(a, kind="stable")
        a, b, c, gain = a[order], b[order], c[order], gain[order]
        short = _low_bytes(b >> np.uint64(64 - FOLLOWER_BITS), SHORT).view(f"V{SHORT}")
        return _dealt(sent.value.of(a, b), {"a": a, "b": short, "c": c.astype(np.int32), "x": gain.astype(np.float16)}, _in_steps)

    def encode(key, pdf):
        place, owner = int(key[0]), sent.value.owner(int(key[0]))
        x = _gathered(pdf["pairs"], _from_steps)
        b = _from_low_bytes(x["b"].view(np.uint8), SHORT) << np.uint64(64 - FOLLOWER_BITS)
        contexts, at = np.unique(x["a"], return_inverse=True)
        followers, counts = np.bincount(at), np.bincount(at, x["c"]).astype(np.int64)
        shift = np.log10(counts[at]) if owner is None else 0.0
        start, end = _bounds(place, sent.value.sections) if owner is None else (int(contexts[0]), int(contexts[0]) + 1)
        blob = build_section(start, end, contexts, counts, np.log10(DISCOUNT * followers / counts), x["a"], b, x["x"].astype(float) - shift)
        return pd.DataFrame({"place": [place], "t": [int(followers.sum())], "blob": [blob]})

    weighed = dealt_pairs(train, places).groupBy("place").applyInPandas(weigh, "place long, pairs binary")
    return kept(weighed.groupBy("place").applyInPandas(encode, "place long, t long, blob binary"), "lm-sections"), places, total, distinct


def _used(codes: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes as numbers in a book of those that occur, and that book."""
    used = np.flatnonzero(np.bincount(codes, minlength=256))
    number = np.zeros(256, np.uint8)
    number[used] = np.arange(len(used))
    return number[codes], book[used]


class RoundTrie:
    """Sections that answer look-ups, read where the task's process received them.

    ``parts`` has ``(place, first, blob)``, where ``first`` marks one place of each word with several, and ``left`` r(v) of such words by their number.
    """

    def __init__(self, parts: list[tuple[int, bool, bytes]], places: Places, left: dict[int, float]):
        self.parts = [(Section(blob, 0), place, first) for place, first, blob in parts]
        self.places, self.left = places, left

    def answer(self, place: int, contexts: np.ndarray, followers: np.ndarray, short: np.ndarray) -> dict[str, np.ndarray]:
        """What a place knows of ``contexts``, each with its number of ``followers`` in ``short``: counts and weights
        left over per context, and which followers are known with which gains. Weights and gains are numbers in a book of those that occur."""
        owner = self.places.owner(place)
        section = next((s for s, at, _ in self.parts if at == place), None)
        if section is None:
            node, count = np.full(len(contexts), -1), np.zeros(len(contexts), np.int64)
        else:
            node, count = section.find(contexts)
        hit, gain, book = np.zeros(len(short), bool), np.zeros(0, np.uint8), np.zeros(0, np.float32)
        parent = np.repeat(node, followers)
        asked = np.flatnonzero(parent >= 0)
        if len(asked):
            at, same = section.follower(parent[asked], short[asked])
            hit[asked[same]] = True
            gain, book = _used(section.gain[at[same]], section.gain_book)
        if owner is not None:  # its followers are spread over several places, its numbers are known to all
            count = np.full(len(contexts), self.places.counts[owner])
            left, weights = np.zeros(len(contexts), np.uint8), np.log10([self.left[owner]])
        elif section is not None:
            left, weights = _used(section.backoff[np.maximum(node, 0)], section.backoff_book.astype(float))
        else:
            left, weights = np.zeros(len(contexts), np.uint8), np.zeros(1)
        seen = 1 if owner is None else int(self.places.counts[owner])
        return {
            "n": np.array([len(contexts)]), "followers": _planes(followers), "count": _planes(count), "left": left, "weights": weights,
            "hit": np.packbits(hit), "gain": gain, "book": book, "seen": np.array([seen]),
        }


def _answered(answer: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Count of the context of every pair of an answer, and what the pair adds to the unigram log10 probability of its follower."""
    n = int(answer["n"][0])
    followers = _from_planes(answer["followers"], n).astype(np.int64)
    count = np.repeat(_from_planes(answer["count"], n).astype(np.int64), followers)
    value = np.where(count > 0, np.repeat(answer["weights"][answer["left"]], followers), 0.0)
    hit = np.flatnonzero(np.unpackbits(answer["hit"], count=len(count)))
    if len(hit):
        gains = answer["book"][answer["gain"]].astype(float)
        value[hit] = np.log10(10.0**gains / int(answer["seen"][0]) + 10.0 ** value[hit])
    return count, value


def _ids_as_bytes(ids: list[pa.Array]) -> bytes:
    out = pa.BufferOutputStream()
    whole = pa.table({"doc_id": pa.chunked_array(ids)})
    with pa.ipc.new_stream(out, whole.schema) as stream:
        stream.write_table(whole)
    return out.getvalue().to_pybytes()


_ASKED = {"place": pa.int64(), "round": pa.int64(), "blob": pa.binary(), "ids": pa.binary()}
_ASKED_DDL = "place long, round long, blob binary, ids binary"


def _asked(rows: list[tuple[int, int, bytes, bytes | None]]) -> dict[str, pa.Array]:
    return {name: pa.array([row[i] for row in rows], kind) for i, (name, kind) in enumerate(_ASKED.items())}


def look_ups(docs: DataFrame, places: Places, round_bytes: int) -> DataFrame:
    """``place, round, blob, ids``: per round and place the distinct contexts with their followers, and a row
    with a negative place for the round itself: its ids, the lengths of its texts, how often each pair is in them and in which, by pair."""
    sent = Sent(docs.sparkSession, places)
    most = max(1, round_bytes // 16)

    def asked_of(number: int, ids: list[pa.Array], lengths: np.ndarray, tokens: np.ndarray, words: np.ndarray, end: int) -> pa.RecordBatch:
        before = _before(tokens, end).astype(np.int64)
        pairs = before * len(words) + tokens
        sorted_by = np.argsort(pairs, kind="stable")
        pairs = pairs[sorted_by]
        at = np.flatnonzero(np.diff(pairs, prepend=-1))
        times = np.diff(at, append=len(pairs))
        pairs = pairs[at]
        del before, tokens
        first, second = np.divmod(pairs, len(words))
        place = sent.value.of(words[first], words[second])
        order = np.argsort(place, kind="stable")
        text = np.repeat(np.arange(len(lengths)), lengths)[sorted_by]
        at, times = at[order], times[order]  # the texts of a pair move with it
        text = text[np.repeat(at - np.cumsum(times) + times, times) + np.arange(len(text))]
        own = {"lengths": lengths, "texts": _planes(text), "times": _planes(times - 1)}
        place, first = place[order], first[order]
        short = _low_bytes(words[second[order]] >> np.uint64(64 - FOLLOWER_BITS), SHORT)
        key = TaskContext.get().partitionId() << 32 | number
        rows = [(-1 - key, key, _sealed(own), _ids_as_bytes(ids))]
        del sorted_by, at, times, own, text, pairs
        starts = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (first[1:] != first[:-1])]))
        ends = np.append(starts[1:], len(place))
        cuts = np.flatnonzero(np.concatenate([[True], place[starts[1:]] != place[starts[:-1]]]))
        for i, j in zip(cuts, [*cuts[1:], len(starts)]):
            low, high = starts[i], ends[j - 1]
            a = words[first[starts[i:j]]]
            blob = {"n": np.array([len(a)]), "a": a[:1], "steps": _planes(np.diff(a)), "followers": _planes(ends[i:j] - starts[i:j]), "b": short[low * SHORT : high * SHORT]}
            rows.append((int(place[low]), key, _sealed(blob), None))
        return pa.RecordBatch.from_pydict(_asked(rows))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, whole in enumerate(_rounds(batches, most)):
            yield asked_of(number, *whole)

    return docs.select("doc_id", "text").mapInArrow(ask, _ASKED_DDL)


def answers(asked: DataFrame, sections: DataFrame, places: Places, left: dict[int, float]) -> DataFrame:
    """The look-ups answered where the sections are; rows of the rounds themselves pass."""
    sent = Sent(asked.sparkSession, (places, left))

    def answer(found: pa.Table, model: pa.Table) -> pa.Table:
        where, weights = sent.value
        parts = [(p, True, blob.as_buffer()) for p, blob in zip(model.column("place").to_pylist(), model.column("blob"))]
        trie, rows = RoundTrie(parts, where, weights), []
        for place, number, blob, ids in zip(*(found.column(name) for name in _ASKED)):
            place, number = place.as_py(), number.as_py()
            if place < 0:
                rows.append((place, number, blob.as_py(), ids.as_py()))
                continue
            x = _opened(blob.as_buffer())
            n = int(x["n"][0])
            contexts = np.cumsum(np.concatenate([x["a"], _from_planes(x["steps"], n - 1)]), dtype=np.uint64)
            followers = _from_planes(x["followers"], n).astype(np.int64)
            rows.append((place, number, _sealed(trie.answer(place, contexts, followers, _from_low_bytes(x["b"], SHORT))), None))
        return pa.table(_asked(rows))

    right = sections.select("place", "blob")
    return asked.groupBy("place").cogroup(right.groupBy("place")).applyInArrow(answer, _ASKED_DDL)


def added_up(answered: DataFrame, kind: str) -> DataFrame:
    """``doc_id, n_tokens, k, b, e`` of every text: known tokens, what their counts add to the unigram log10 sum of unknown ones, and what the pairs add."""

    def add(found: pa.Table) -> pa.Table:
        found = found.sort_by("place")
        places = found.column("place").to_pylist()
        blobs = found.column("blob")
        own = _opened(blobs[0].as_buffer())  # the round's row comes first
        counts, values = (np.concatenate(x) for x in zip(*(_answered(_opened(blobs[i].as_buffer())) for i in range(1, len(places)))))
        lengths, times = own["lengths"], _from_planes(own["times"], len(counts)).astype(np.int64) + 1
        text = _from_planes(own["texts"], int(lengths.sum())).astype(np.int64)
        # an end token stands before a text and at its end, so its contexts are its tokens
        sums = [np.bincount(text, np.repeat(x, times), len(lengths)) for x in (counts > 0, np.log10(counts + 1), values)]
        ids = pa.ipc.open_stream(found.column("ids")[0].as_buffer()).read_all().column("doc_id")
        return pa.table({"doc_id": ids, "n_tokens": lengths, **dict(zip("kbe", sums))})

    return answered.groupBy("round").applyInArrow(add, f"doc_id {kind}, n_tokens long, k double, b double, e double")


def score_texts(docs: DataFrame, train: DataFrame, entries: int = SECTION_ENTRIES, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    ``base_score`` is the add-one unigram sum, ``score`` the log10 probability of the
    bigram model. Words are told apart by 64 bits of hash. Texts are looked up in rounds of ``round_bytes``; a round holds whole texts,
    so the result does not depend on their number. The model stays where it is stored.

    Null and empty texts consist of the end token. Rows that share id and text share their
    result, null ids are ids. Without training text N and V are 0. No rows: no rows.
    """
    sections, places, total, distinct = build_trie(train.select("text"), entries)
    left: dict[int, float] = {}
    for f in sections.where(F.col("place") >= places.sections).select("place", "t").orderBy("place").collect():  # places of frequent words
        owner = places.owner(f["place"])
        left[owner] = left.get(owner, 0.0) + DISCOUNT * f["t"] / float(places.counts[owner])
    asked = look_ups(docs, places, round_bytes)
    sums = added_up(answers(asked, sections, places, left), docs.schema["doc_id"].dataType.simpleString())
    base = F.col("b") - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))
    return sums.select(
        "doc_id",
        "n_tokens",
        F.col("k").cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (base + F.col("e")).alias("score"),
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), FOLD) == HELD_OUT
    scored = score_texts(docs, docs.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
