"""SentencePiece (merge type) encoding and decoding by a table of last tokens.

The encoding of a text by merges has a property: its first tokens are the encoding of the prefix
they cover. So each prefix has one last token. For growing prefixes an automaton gives all tokens
that end there, and the one is kept that is compatible with the last token of the prefix before it:
merging the two alone must leave them as they are. The ids are then read backwards from the end.
The time is linear in the text, also for one very long word.

Texts are cut before each run of spaces and around line breaks; no token of the model may span such
a cut, which is checked. Units are cut further where letters meet other characters, if the two stand side
by side in no token, so a word is known with any sign behind it. Units and parts recur, so their ids are
kept in one bounded table per worker.

Defined cases: a null or empty text has no ids and decodes to the empty text; characters that the
model lacks are encoded as their UTF-8 bytes; repeated rows each get their own result; an empty table
gives an empty table. Only ``doc_id`` and the results are returned by :func:`encode`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, ship
from .hashing import released, tables_of

SPACE = "▁"
#: A run of spaces with the word behind it, a line break, or what stands between such.
UNIT = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
#: A run of letters with the space before it, or of other characters.
RUN = re.compile(rf"{SPACE}?[^\W\d_]+|[\W\d_]+")
#: Units and parts in each of two generations kept per worker, and the longest that is kept.
KEPT_UNITS = 150_000
#: Rows encoded and returned at a time.
SLICE_ROWS = 500
KEPT_LENGTH = 40
_NEVER = float("inf")


class Pieces:
    """Merge tables of one model file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = lambda i: model.is_unknown(i) or model.is_control(i) or model.is_byte(i)
        if any(model.is_unused(i) for i in range(size)) or model.piece_to_id("<0x00>") == model.unk_id():
            raise ValueError("the model must be of merge type with byte fallback and no unused pieces")
        self.piece = [model.id_to_piece(i) for i in range(size)]
        self.id = {self.piece[i]: i for i in range(size) if not special(i)}
        self.cost = {p: -model.get_score(i) for p, i in self.id.items()}
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_value = {i: b for b, i in enumerate(self.byte)}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) or "\n" in p for p in self.id):
            raise ValueError("a piece of the model spans a cut between units")
        # For each token: its parts on the way to it, seen from its right and from its left edge.
        self.right: dict[str, list[tuple[str, float]]] = {}
        self.left: dict[str, list[tuple[str, float]]] = {}
        self.steady: set[str] = set()
        automaton = ahocorasick.Automaton()
        for p in sorted(self.id, key=len):
            if self._edges(p):
                automaton.add_word(p, (len(p), p))
        automaton.make_automaton()
        self.automaton = automaton
        #: Pairs of neighbouring characters inside some piece: no merge crosses any other pair.
        self.inside = {p[k : k + 2] for p in self.id for k in range(len(p) - 1)}
        self.fits: dict[str, dict[str, bool]] = {}
        self.n_fits = 0
        #: Ids, as decimal text, of units and parts that decode to themselves: the younger and the older half.
        self.units: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.text = [p.replace(SPACE, " ") for p in self.piece]

    def _merge(self, text: str) -> tuple[list[str], list[tuple[str, str]]]:
        """Plain merging of a short text: the cheapest pair first, the leftmost of equals."""
        parts, made = list(text), []
        while True:
            costs = [self.cost.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
            best = min(costs, default=_NEVER)
            if best == _NEVER:
                return parts, made
            k = costs.index(best)
            made.append((parts[k], parts[k + 1]))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def _edges(self, piece: str) -> bool:
        """Record the edges of a piece; False when merging never makes it."""
        if len(piece) == 1:
            self.right[piece] = self.left[piece] = [(piece, _NEVER)]
            self.steady.add(piece)
            return True
        parts, made = self._merge(piece)
        if len(parts) > 1:
            return False
        a, b = made[-1]
        cost = self.cost[piece]
        self.right[piece] = [*self.right[b][:-1], (b, cost), (piece, _NEVER)]
        self.left[piece] = [*self.left[a][:-1], (a, cost), (piece, _NEVER)]
        costs = [self.cost[x + y] for x, y in made]
        if a in self.steady and b in self.steady and cost > max([*costs[:-1], 0]):
            self.steady.add(piece)
        return True

    def compatible(self, a: str, b: str) -> bool:
        """True when merging ``a`` and ``b`` side by side leaves both whole."""
        if self.n_fits > KEPT_UNITS:
            self.fits, self.n_fits = {}, 0
        self.n_fits += 1
        fit = self.fits.setdefault(a, {})[b] = self._compatible(a, b)
        return fit

    def _compatible(self, a: str, b: str) -> bool:
        if a not in self.steady or b not in self.steady:
            return self._merge(a + b)[0] == [a, b]
        right, left, i, j = self.right[a], self.left[b], 0, 0
        while True:
            (x, grows_x), (y, grows_y) = right[i], left[j]
            cost = self.cost.get(x + y, _NEVER)
            # Of equal costs the leftmost pair goes first.
            if cost < grows_x and cost <= grows_y:
                return False
            if grows_x == grows_y == _NEVER:
                return True
            if grows_x <= grows_y:
                i += 1
            else:
                j += 1

    def tokens(self, text: str) -> list[str]:
        """Tokens of a text; a character that the model lacks stands alone."""
        n, right, fits = len(text), self.right, self.fits
        last: list[str | None] = [None] * (n + 1)
        last[0] = ""
        nothing: dict[str, bool] = {}
        for end, (size, piece) in self.automaton.iter(text):
            end += 1
            if last[end] is not None:
                continue
            before = last[end - size]
            if before is None:
                # The prefix before ends with a character that the model lacks.
                before = text[end - size - 1]
            fit = fits.get(before, nothing).get(piece)
            if fit is None and before in right:
                fit = self.compatible(before, piece)
                fits = self.fits
            if fit is not False:
                last[end] = piece
        out = []
        while n:
            piece = last[n] or text[n - 1]
            out.append(piece)
            n -= len(piece)
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        """Ids of one unit."""
        ids: list[int] = []
        for token in self.tokens(text):
            known = self.id.get(token)
            if known is None:
                ids += [self.byte[b] for b in token.encode()]
            else:
                ids.append(known)
        return ids

    def decode(self, ids: list[int]) -> str:
        """Text of ids, the space in front of it included; broken bytes become U+FFFD."""
        if self.byte_value.keys().isdisjoint(ids):
            return "".join([self.text[i] for i in ids])
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_value:
                run.append(self.byte_value[i])
                continue
            if run:
                out.append(_utf8(run))
                run = bytearray()
            out.append(self.text[i])
        if run:
            out.append(_utf8(run))
        return "".join(out)

    def part(self, text: str) -> tuple[str, str | None]:
        """Ids of a part of a unit as decimal text, and the part decoded from them if that is another text."""
        ids = self.encode(text)
        known, decoded = ",".join(map(str, ids)), self.decode(ids)
        if decoded != text.replace(SPACE, " "):
            return known, decoded
        self._keep(text, known)
        return known, None

    def _keep(self, text: str, known: str) -> None:
        if len(text) <= KEPT_LENGTH:
            if len(self.units) >= KEPT_UNITS:
                self.units, self.older = {}, self.units
            self.units[text] = known

    def _cut(self, text: str) -> list[str]:
        """Parts of a unit: its runs of letters and of other characters, where no piece spans the cut."""
        if (text[1:] if text[0] == SPACE else text).isalpha():
            return [text]
        parts: list[str] = []
        for run in RUN.findall(text):
            if parts and parts[-1][-1] + run[0] in self.inside:
                parts[-1] += run
            else:
                parts.append(run)
        return parts

    def unit(self, text: str) -> tuple[str, str | None]:
        """Ids of a unit as decimal text, and the unit decoded from them if that is another text."""
        known = self.older.get(text)
        if known is None:
            parts = self._cut(text)
            if len(parts) == 1:
                return self.part(text)
            ids, odd = [], {}
            for i, part in enumerate(parts):
                known = self.units.get(part) or self.older.get(part)
                if known is None:
                    known, decoded = self.part(part)
                    if decoded is not None:
                        odd[i] = decoded
                ids.append(known)
            known = ",".join(ids)
            if odd:
                return known, "".join([odd[i] if i in odd else p.replace(SPACE, " ") for i, p in enumerate(parts)])
        self._keep(text, known)
        return known, None

    def whole(self, text: str) -> tuple[str, str]:
        """Ids of a text as decimal text with commas, and the text decoded from them."""
        if not text:
            return "", ""
        marked = SPACE + text.replace(" ", SPACE)
        units = UNIT.findall(marked)
        ids = [*map(self.units.get, units)]
        odd = {}
        missed = [i for i, known in enumerate(ids) if known is None] if None in ids else ()
        for i in missed:
            # An earlier miss may have been the same unit.
            known = self.units.get(units[i])
            if known is None:
                known, decoded = self.unit(units[i])
                if decoded is not None:
                    odd[i] = decoded
            ids[i] = known
        if not odd:
            return ",".join(ids), marked.replace(SPACE, " ").removeprefix(" ")
        return ",".join(ids), "".join([odd[i] if i in odd else u.replace(SPACE, " ") for i, u in enumerate(units)]).removeprefix(" ")


def _utf8(run: bytearray) -> str:
    return bytes(run).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    """Tables of a model file, made once per worker as long as it encodes."""
    return Pieces(path)


tables_of[__name__] = load.cache_clear


def _encoder(path: str, keep_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            # Small slices: the ids of a whole batch would take many times the memory of its texts.
            for at in range(0, batch.num_rows, SLICE_ROWS):
                yield _encoded(pieces, batch.slice(at, SLICE_ROWS), keep_ids)

    return run


def _encoded(pieces: Pieces, batch: pa.RecordBatch, keep_ids: bool) -> pa.RecordBatch:
    counts, ids_hash, text_hash, kept = [], [], [], []
    for text in batch.column("text").to_pylist():
        ids, decoded = pieces.whole(text or "")
        counts.append(ids.count(",") + 1 if ids else 0)
        ids_hash.append(hashlib.sha256(ids.encode()).hexdigest())
        text_hash.append(hashlib.sha256(decoded.encode()).hexdigest())
        if keep_ids:
            kept.append(np.array(ids.split(",") if ids else [], np.int32))
    columns = {
        "doc_id": batch.column("doc_id"),
        "n_tokens": pa.array(counts, pa.int64()),
        "ids_sha256": pa.array(ids_hash, pa.string()),
        "decoded_sha256": pa.array(text_hash, pa.string()),
    }
    if keep_ids:
        ends = np.cumsum([0, *counts]).astype(np.int32)
        columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *kept])))
    return pa.RecordBatch.from_pydict(columns)


def encode(docs: DataFrame, path: str, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and on demand ``ids``.

    ``path`` names the model file, which every executor must have.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(released(_encoder(path, keep_ids)), schema)


def decode_ids(ids: Column | str, path: str) -> Column:
    """Text of an array of ids, by an Arrow-batched function."""

    @F.pandas_udf("string")
    def run(column):
        pieces = load(path)
        return column.map(lambda x: None if x is None else pieces.decode([int(i) for i in x]).removeprefix(" "))

    return run(ids)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return encode(documents(spark, folder, "doc_id", "text"), model_path())
