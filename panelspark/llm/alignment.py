"""Alignment of the tokens that two tokenizers make of the same text."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, process_cache, scratch
from .packing import _AWKWARD

#: Bytes of text that are aligned at once (a longer text alone).
BATCH_BYTES = 1 << 20
#: Words whose ids a worker remembers (beyond them the memory is emptied), and the longest such word.
REMEMBERED = 200_000
REMEMBERED_LENGTH = 64


def byte_level_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable Latin-1 bytes are themselves, the others follow from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _lossless_encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """The ids of a byte-level vocabulary; where it is also there as ranks, a faster encoder computes the same ids."""
    import base64

    import public_tokenizers
    from tokenizers import Tokenizer

    try:
        import tiktoken

        with open(public_tokenizers.path(vocabulary.replace(".json", ".tiktoken")), "rb") as f:
            ranks = {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, f)}
        return tiktoken.Encoding("align", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    except (ImportError, FileNotFoundError):
        tok = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        tok.encode_special_tokens = True
        return lambda text: tok.encode(text, add_special_tokens=False).ids


def _sides(vocabulary_a: str, vocabulary_b: str):
    """(encoder of A, processor of B, bytes of each A id, bytes of each B id), once for each worker."""
    cache = process_cache()
    if ("align", vocabulary_a, vocabulary_b) not in cache:
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        alphabet = byte_level_alphabet()
        tok = Tokenizer.from_file(public_tokenizers.path(vocabulary_a))
        bytes_a = [b""] * tok.get_vocab_size()
        for entry, i in tok.get_vocab().items():
            bytes_a[i] = bytes(alphabet[c] for c in entry)
        b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary_b))
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        cache["align", vocabulary_a, vocabulary_b] = _lossless_encoder(vocabulary_a), b, bytes_a, bytes_b
    return cache["align", vocabulary_a, vocabulary_b]


def token_ids(vocabulary_a: str, vocabulary_b: str) -> Callable[[list[str | None]], list[tuple[bytes, bytes]]]:
    """Maps texts to their (A ids of space + text, B ids of text) as uint32 bytes, both empty where the bytes of either differ from space + text.

    Neither tokenizer joins a space to a non-space before it, so a text is
    cut before single spaces and the ids of words are remembered. A text
    with other spaces, or with a word whose bytes differ, is encoded whole.
    """
    encode_a, b, bytes_a, bytes_b = _sides(vocabulary_a, vocabulary_b)
    length_a, length_b = _lengths(bytes_a), _lengths(bytes_b)
    known = process_cache().setdefault(("align-words", vocabulary_a, vocabulary_b), ({}, {}))  # ids of either side by word
    known_a, known_b = known

    def whole(text: str) -> tuple[bytes, bytes]:
        ids_a, ids_b, raw = encode_a(" " + text), b.encode(text), (" " + text).encode()
        if b"".join([bytes_a[i] for i in ids_a]) == raw == b"".join([bytes_b[i] for i in ids_b]):
            return array("I", ids_a).tobytes(), array("I", ids_b).tobytes()
        return b"", b""

    def remember(words: list[str]) -> None:
        """The ids of words: of A from one call for all, as a text of their own; None for a word whose bytes differ."""
        if len(words) == 1:
            found = whole(words[0])
            known_a[words[0]], known_b[words[0]] = found if found[0] else (None, None)
            return
        raw = (" " + " ".join(words)).encode()
        ids_a = encode_a(" " + " ".join(words))
        lists = b.encode(words, num_threads=1)
        ids_b = list(chain.from_iterable(lists))
        stops_b = np.cumsum(list(map(len, lists)))
        found = np.array(ids_a, dtype="<u4")
        upto, ends = np.cumsum(length_a[found]), np.append(np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 32)[1:], len(raw))
        same = b"".join([bytes_a[i] for i in ids_a]) == raw == b"".join([bytes_b[i] for i in ids_b])
        if same and (np.cumsum(length_b[np.array(ids_b)])[stops_b - 1] == ends).all():
            stops_a = np.searchsorted(upto, ends) + 1
            if (upto[stops_a - 1] == ends).all():
                for side, raw_ids, stops in ((known_a, found.tobytes(), stops_a), (known_b, array("I", ids_b).tobytes(), stops_b)):
                    at = [0, *(4 * stops).tolist()]
                    side.update(zip(words, [raw_ids[i:j] for i, j in zip(at, at[1:])]))
                return
        half = len(words) // 2  # some word's bytes differ: find it
        remember(words[:half])
        remember(words[half:])

    def ids(texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        if len(known_a) > REMEMBERED:
            known_a.clear()
            known_b.clear()
        split = [t.split(" ") if t and not _AWKWARD.search(t) else None for t in texts]
        new = list(set(chain.from_iterable(words for words in split if words)).difference(known_a))
        if new:
            remember(new)
        out = []
        for text, words in zip(texts, split):
            try:
                out.append(tuple(b"".join(map(side.__getitem__, words)) for side in known) if words else whole(text) if text else (b"", b""))
            except TypeError:  # a None among the words
                out.append(whole(text))
        for w in new:
            if len(w) > REMEMBERED_LENGTH:
                del known_a[w], known_b[w]
        return out

    return ids


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token of A, token of B) of all pairs whose byte ranges overlap, from the starts of tokens that cover the same bytes without gaps.

    Starts count from the first document of the batch, so they ascend. An
    as-of merge keyed by document finds for each token start the other
    side's covering token; the union of both directions is all overlaps, as
    the later of two overlapping tokens starts within the other.
    """
    a = pd.DataFrame({"at": start_a, "doc": doc_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"at": start_b, "doc": doc_b, "b": np.arange(len(start_b))})
    in_b = pd.merge_asof(a, b, on="at", by="doc")["b"].to_numpy().astype(np.int64)
    in_a = pd.merge_asof(b, a, on="at", by="doc")["a"].to_numpy().astype(np.int64)
    later = start_a[in_a] < start_b if len(in_a) else np.zeros(0, dtype=bool)  # equal starts are there already
    return np.concatenate([a["a"].to_numpy(), in_a[later]]), np.concatenate([in_b, b["b"].to_numpy()[later]])


class Aligned:
    """The tokens of a batch of documents on both sides, and which of them end a group."""

    def __init__(self, encoded: list[tuple[bytes, bytes]], length_a: np.ndarray, length_b: np.ndarray):
        self.counts = np.array([(len(a) // 4, len(b) // 4) for a, b in encoded], dtype=np.int64).reshape(-1, 2)
        self.a, self.b = (np.frombuffer(b"".join(x), dtype="<u4") for x in zip(*encoded)) if encoded else (np.zeros(0, dtype="<u4"),) * 2
        docs = np.arange(len(encoded))
        self.doc_a, self.doc_b = np.repeat(docs, self.counts[:, 0]), np.repeat(docs, self.counts[:, 1])
        self.end_a, self.end_b = np.cumsum(length_a[self.a]), np.cumsum(length_b[self.b])
        self.start_a, self.start_b = self.end_a - length_a[self.a], self.end_b - length_b[self.b]
        self.pair_a, self.pair_b = overlaps(self.doc_a, self.start_a, self.doc_b, self.start_b)
        together = self.end_a[self.pair_a] == self.end_b[self.pair_b]
        order = np.argsort(self.pair_a[together], kind="stable")
        #: The links: pairs that end together, in order of place; each ends a group.
        self.last_a, self.last_b = self.pair_a[together][order], self.pair_b[together][order]


def _sub_batches(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    held, size, lo = [], 0, 0
    for i in range(len(texts)):
        text = texts[i].as_py()
        if held and size + len(text or "") > BATCH_BYTES:
            yield lo, held
            held, size, lo = [], 0, i
        held.append(text)
        size += len(text or "")
    if held:
        yield lo, held


def _lengths(table: list[bytes]) -> np.ndarray:
    return np.array([len(x) for x in table], dtype=np.int64)


def token_overlaps(docs: DataFrame, vocabulary_a: str = "byte_bpe_50k.json", vocabulary_b: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each pair of an A and a B token whose byte ranges overlap:
    (doc_id, a_index, b_index, a_id, b_id, a_start, a_end, b_start, b_end).

    Offsets count the bytes of space + text. Texts without tokens (see
    :func:`align`) have no rows; repeated rows each have theirs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = token_ids(vocabulary_a, vocabulary_b)
        _, _, bytes_a, bytes_b = _sides(vocabulary_a, vocabulary_b)
        length_a, length_b = _lengths(bytes_a), _lengths(bytes_b)
        for batch in batches:
            for lo, texts in _sub_batches(batch.column(1)):
                x = Aligned(ids(texts), length_a, length_b)
                i, j = x.pair_a, x.pair_b
                if not len(i):
                    continue
                doc = x.doc_a[i]
                first = np.concatenate([np.zeros((1, 2), dtype=np.int64), np.cumsum(x.counts, axis=0)])[doc]
                base = x.start_a[first[:, 0]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).cast(pa.int64()).take(pa.array(lo + doc)),
                        *[pa.array(c.astype(np.int64)) for c in (i - first[:, 0], j - first[:, 1], x.a[i], x.b[j], x.start_a[i] - base, x.end_a[i] - base, x.start_b[j] - base, x.end_b[j] - base)],
                    ],
                    names=["doc_id", "a_index", "b_index", "a_id", "b_id", "a_start", "a_end", "b_start", "b_end"],
                )

    schema = "doc_id long, a_index long, b_index long, a_id long, b_id long, a_start long, a_end long, b_start long, b_end long"
    return pick(docs, id=id_col, text=text_col).mapInArrow(run, schema)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their summed counts."""
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1 if len(keys) else keys) != 0) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _group_text(a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, tables: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The groups of tokens as text: (bytes, end of each A token's place, end of each B token's place).

    ``last_a`` and ``last_b`` are the tokens that end the groups. A group's
    A ids stand before its B ids, so the place of an A token moves on by the
    B tokens of earlier groups, that of a B token by the A tokens up to its
    own group.
    """
    digits, sizes, base_b = tables
    mark_a, mark_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
    mark_a[last_a] = 1
    mark_b[last_b] = 1
    place_a = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[np.cumsum(mark_a) - mark_a]
    place_b = np.arange(len(b)) + (last_a + 1)[np.cumsum(mark_b) - mark_b] if len(b) else np.zeros(0, dtype=np.int64)
    code = np.empty(len(a) + len(b), dtype=np.int64)
    code[place_a] = 2 * a.astype(np.int64) + mark_a
    code[place_b] = base_b + 2 * b.astype(np.int64) + mark_b
    ends = np.cumsum(sizes[code])
    text = digits[code][np.arange(digits.shape[1]) < sizes[code][:, None]]
    return text, ends[place_a] if len(a) else place_a, ends[place_b] if len(b) else place_b


def _text_tables(size_a: int, size_b: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bytes and their number for each id followed by its mark: a comma, or at the end of a group's side | (A) and ; (B)."""
    entries = [f"{i}{m}".encode() for n, marks in ((size_a, ",|"), (size_b, ",;")) for i in range(n) for m in marks]
    wide = max(map(len, entries))
    digits = np.frombuffer(b"".join(e.ljust(wide) for e in entries), dtype=np.uint8).reshape(-1, wide)
    return digits, np.array([len(e) for e in entries], dtype=np.int64), 2 * size_a


ENCODED = "kind int, doc_id long, a binary, b binary, last binary"


def align(docs: DataFrame, vocabulary_a: str = "byte_bpe_50k.json", vocabulary_b: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups).

    A encodes space + text, B text (it adds the space itself), both without
    special tokens. Where A and B tokens end at the same byte a group ends;
    ``groups`` lists them as ``a1,a2|b1;a3|b2,b3``. A link is a pair of an A
    and a B token that end together. The count of a pair of ids is how many
    links of all documents hold it; ``n_best`` counts the links whose count is
    the highest of their B id (ties included), ``count_sum`` adds up the counts.

    Texts that are null, empty or that either tokenizer does not give back
    byte by byte have no tokens: zeros and an empty text. Every row counts,
    repeated ones and those with a null id too; an empty table gives an
    empty result. Columns other than the two named are ignored.

    Of two tokens that end together one is a suffix of the other, so there
    are no more pairs of ids than suffixes of vocabulary entries, whatever
    the corpus (about 0.7 million here): tasks send their sums, Spark adds
    them up, and the table of counts is broadcast.
    """
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = token_ids(vocabulary_a, vocabulary_b)
        _, _, bytes_a, bytes_b = _sides(vocabulary_a, vocabulary_b)
        length_a, length_b = _lengths(bytes_a), _lengths(bytes_b)
        narrow = "<u2" if max(len(bytes_a), len(bytes_b)) <= 1 << 16 else "<u4"
        types = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        names = ["kind", "doc_id", "a", "b", "last"]
        sums: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for lo, texts in _sub_batches(batch.column(1)):
                x = Aligned(ids(texts), length_a, length_b)
                keys, n = np.unique(x.a[x.last_a].astype(np.int64) << 32 | x.b[x.last_b].astype(np.int64), return_counts=True)
                sums.append((keys, n))
                if sum(len(k) for k, _ in sums) > 1 << 20:
                    sums = [_merged(sums)]
                ends = np.zeros(len(x.a) + len(x.b), dtype=bool)  # of a document: its A tokens, then its B tokens
                before = np.concatenate([np.zeros((1, 2), dtype=np.int64), np.cumsum(x.counts, axis=0)])
                ends[x.last_a + before[x.doc_a[x.last_a], 1]] = True
                ends[x.last_b + before[x.doc_b[x.last_b] + 1, 0]] = True
                a, b = x.a.astype(narrow), x.b.astype(narrow)
                cut = before.tolist()
                rows = [(a[p:r].tobytes(), b[q:s].tobytes(), np.packbits(ends[p + q : r + s]).tobytes()) for (p, q), (r, s) in zip(cut, cut[1:])]
                cols = [np.zeros(len(texts), dtype=np.int32), batch.column(0)[lo : lo + len(texts)].cast(pa.int64()), *zip(*rows)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=t) for c, t in zip(cols, types)], names=names)
        if sums:
            keys, n = _merged(sums)
            yield pa.RecordBatch.from_arrays([pa.array([c], type=t) for c, t in zip((1, None, keys.tobytes(), n.astype(np.int64).tobytes(), None), types)], names=names)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in zip(batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(c.as_py(), dtype=np.int64)) for c in (keys, n)], names=["pair", "n"])

    stored = scratch(pick(docs, id=id_col, text=text_col).mapInArrow(encode, ENCODED), "align-tokens")
    pairs = stored.filter("kind = 1").select("a", "b").mapInArrow(spread, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pair, count = pairs["pair"].to_numpy(), pairs["n"].to_numpy()
    order = np.argsort(pair)
    pair, count = pair[order], count[order]
    most = np.zeros(int((pair & 0xFFFFFFFF).max(initial=0)) + 1, dtype=np.int64)
    np.maximum.at(most, pair & 0xFFFFFFFF, count)
    table = spark.sparkContext.broadcast((pair, count, count == most[pair & 0xFFFFFFFF]))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, bytes_a, bytes_b = _sides(vocabulary_a, vocabulary_b)
        narrow = np.dtype("<u2" if max(len(bytes_a), len(bytes_b)) <= 1 << 16 else "<u4")
        tables = _text_tables(len(bytes_a), len(bytes_b))
        pair, count, best = table.value
        for batch in batches:
            sizes = sum(pc.binary_length(batch.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in (1, 2))
            cuts = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(sizes) // (4 * BATCH_BYTES))) + 1, [batch.num_rows]]))
            for lo, hi in zip(cuts.tolist(), cuts[1:].tolist()):
                raw_a, raw_b, flags = (batch.column(c)[lo:hi].to_pylist() for c in (1, 2, 3))
                n_a, n_b = (np.array([len(r) // narrow.itemsize for r in raw], dtype=np.int64) for raw in (raw_a, raw_b))
                a, b = np.frombuffer(b"".join(raw_a), dtype=narrow), np.frombuffer(b"".join(raw_b), dtype=narrow)
                bits = [np.unpackbits(np.frombuffer(f, dtype=np.uint8), count=p + q) for f, p, q in zip(flags, n_a.tolist(), n_b.tolist())]
                last_a = np.flatnonzero(np.concatenate([f[:p] for f, p in zip(bits, n_a.tolist())]))
                last_b = np.flatnonzero(np.concatenate([f[p:] for f, p in zip(bits, n_a.tolist())]))
                doc = np.searchsorted(np.cumsum(n_a), last_a, side="right")
                groups = np.bincount(doc, minlength=hi - lo)
                at = np.searchsorted(pair, a[last_a].astype(np.int64) << 32 | b[last_b].astype(np.int64))
                upto = np.concatenate([[0], np.cumsum(groups)])
                total = lambda values: np.diff(np.concatenate([[0], np.cumsum(values[at], dtype=np.int64)])[upto])  # noqa: B023, E731
                text, _, end_b = _group_text(a, b, last_a, last_b, tables)
                stops = np.concatenate([[0], end_b])[np.cumsum(n_b)]
                starts = np.concatenate([[0], stops[:-1]])
                whole = text.tobytes()
                strings = [whole[p : q - 1] if q > p else b"" for p, q in zip(starts.tolist(), stops.tolist())]  # without the last ;
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(n_a), pa.array(n_b), pa.array(groups), pa.array(groups), pa.array(total(best)), pa.array(total(count)), pa.array(strings, type=pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
                )

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return stored.filter("kind = 0").select("doc_id", "a", "b", "last").mapInArrow(finish, schema)
