"""SentencePiece encoding and decoding for merge-type vocabularies.

Spaces become U+2581 and one is put in front, then every character is a symbol and an agenda holds
the adjacent pairs whose join is a piece, best score first, the leftmost of equal ones first. The top pair is joined, the pairs
with its new neighbours enter, until the agenda is empty; a symbol that is no piece is spelled in bytes. The agenda is a
list of costs in text order for few symbols, and a heap for many.

If no piece has U+2581 behind another character, no pair across the start of a run of U+2581 can ever be
joined, so a text falls into segments that the agenda treats apart; the ids of recent segments are remembered, as bytes, in two
generations of bounded size. Otherwise the whole text is one segment. A new segment falls apart once more between two characters that stand side by side in no piece,
and its parts are remembered like segments. Whole texts are encoded, in Arrow batches; every new segment is compared with the
sentencepiece library (whole texts, where they do not fall into segments): any difference raises.

Defined results: a NULL text counts as empty; an empty text has the end id only (nothing without `add_eos`) and decodes to
an empty text. Repeated rows and NULL ids pass through, one row out for each row in.
"""

import gc
import hashlib
import heapq
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from operator import add

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrisk.llm.common import table

SPACE = "▁"
GENERATION = 200_000  # segments of a generation; a full one replaces the older one, which is forgotten
SHORT = 48  # symbols up to which the agenda is a list
NEVER = float("inf")  # cost of a pair that is no piece


class Generation(dict):
    """Remembered segments and their ids; what is not there is looked for elsewhere by `find`."""

    def __init__(self, find: Callable[[str], bytes]):
        self.find = find

    def __missing__(self, segment: str) -> bytes:
        return self.find(segment)


class PieceVocabulary:
    """Pieces, scores and ids of a merge-type model file, and the agenda over them."""

    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as handle:
            model.ParseFromString(handle.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        if spec.model_type != spec.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only merge-type vocabularies without text normalisation are supported")
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.eos = self.library.eos_id()
        self.unk = self.library.unk_id()
        kinds = model.SentencePiece
        self.ids, self.score, self.bytes = {}, {}, {}
        for number, piece in enumerate(model.pieces):
            if piece.type == kinds.USER_DEFINED or piece.type == kinds.UNUSED:
                raise ValueError("user-defined and unused pieces are not supported")
            if piece.type == kinds.NORMAL:
                self.ids[piece.piece], self.score[piece.piece] = number, piece.score
            elif piece.type == kinds.BYTE:
                self.bytes[int(piece.piece[3:5], 16)] = number
        self.cost = {piece: -score for piece, score in self.score.items()}
        self.beside = {a + b for piece in self.ids for a, b in zip(piece, piece[1:])}
        apart = not any(SPACE in piece.lstrip(SPACE) for piece in self.ids)
        # What the library makes of a segment alone tells only if it starts a text in the same way.
        self.apart = apart and self.prefix == SPACE
        self.fresh: list[tuple[str, list[int]]] = []
        self.segments = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+$" if apart else "(?s).+").findall
        # Ids as bytes of int32; segments that are met again move from the older generation to the newer one.
        self.known = Generation(self._found)
        self.older: dict[str, bytes] = {}
        self.spelled = [str(number) for number in range(len(model.pieces))]

    def agenda(self, segment: str) -> list[int]:
        """Ids of one segment by the score-ordered agenda."""
        if len(segment) <= SHORT:
            return self._ids(self._joined(list(segment)))
        symbols = list(segment)
        n, score = len(symbols), self.score
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for left in range(n - 1):
            pair = symbols[left] + symbols[left + 1]
            if pair in score:
                agenda.append((-score[pair], left, left + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            # A pair is out of date if one of its symbols has been joined meanwhile.
            if symbols[left] is None or symbols[right] is None or after[left] != right or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, None
            follow = after[left] = after[right]
            if follow < n:
                before[follow] = left
                joined = pair + symbols[follow]
                if joined in score:
                    heapq.heappush(agenda, (-score[joined], left, follow, joined))
            lead = before[left]
            if lead >= 0:
                joined = symbols[lead] + pair
                if joined in score:
                    heapq.heappush(agenda, (-score[joined], lead, left, joined))
        return self._ids([symbol for symbol in symbols if symbol is not None])

    def _joined(self, symbols: list[str]) -> list[str]:
        """Few symbols joined by the same rule, with the agenda as a list: the cost of every pair at the place of its left symbol."""
        cost = self.cost.get
        agenda = [cost(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        place = agenda.index
        while agenda and (least := min(agenda)) is not NEVER:
            left = place(least)
            right = left + 1
            symbols[left] = joined = symbols[left] + symbols.pop(right)
            del agenda[left]
            if right < len(symbols):
                agenda[left] = cost(joined + symbols[right], NEVER)
            if left:
                agenda[left - 1] = cost(symbols[left - 1] + joined, NEVER)
        return symbols

    def _ids(self, symbols: list[str]) -> list[int]:
        """Ids of joined symbols."""
        try:
            return [self.ids[symbol] for symbol in symbols]
        except KeyError:  # a symbol is no piece
            out = []
        for symbol in symbols:
            number = self.ids.get(symbol)
            if number is not None:
                out.append(number)
            elif self.bytes:
                out.extend(self.bytes[b] for b in symbol.encode())
            elif not out or out[-1] != self.unk:
                out.append(self.unk)
        return out

    def _parts(self, segment: str) -> list[str]:
        """A segment cut between characters that stand side by side in no piece. Without byte pieces unknown characters fold, so it stays whole."""
        pairs = list(map(add, segment, segment[1:]))
        if not self.bytes or self.beside.issuperset(pairs):
            return [segment]
        beside, parts, start = self.beside, [], 0
        for end, pair in enumerate(pairs, 1):
            if pair not in beside:
                parts.append(segment[start:end])
                start = end
        parts.append(segment[start:])
        return parts

    def _found(self, segment: str) -> bytes:
        """Ids of a segment that is not in the newer generation, or was not in the one that was the newer when its text began."""
        found = self.known.get(segment)
        if found is not None:
            return found
        found = self.older.get(segment)
        if found is not None:
            return self._remembered(segment, found)
        parts = self._parts(segment)
        if len(parts) == 1:
            ids = self.agenda(segment)
            found = self._remembered(segment, array("i", ids).tobytes())
        else:
            found = self._remembered(segment, b"".join([self.known.get(part) or self._of_part(part) for part in parts]))
            ids = memoryview(found).cast("i").tolist()
        # The library puts U+2581 in front itself, but not of an empty text: a U+2581 alone is a single symbol anyway.
        if self.apart and segment != SPACE:
            self.fresh.append((segment, ids))
        return found

    def _of_part(self, part: str) -> bytes:
        found = self.older.get(part)
        return self._remembered(part, array("i", self.agenda(part)).tobytes() if found is None else found)

    def verify(self, texts: list[str], ids: list[list[int]], add_eos: bool) -> None:
        """Raise if the library differs on the segments that are new since the last call, or on whole texts that have none."""
        if self.apart:
            texts, ids, add_eos = [segment[1:] for segment, _ in self.fresh], [found for _, found in self.fresh], False
            self.fresh = []
        if texts and ids != self.library.encode(texts, add_eos=add_eos, num_threads=1):
            raise AssertionError("the agenda and the sentencepiece library disagree")

    def _remembered(self, segment: str, found: bytes) -> bytes:
        if len(segment) <= 64:
            if len(self.known) >= GENERATION:
                self.known, self.older = Generation(self._found), self.known
            self.known[segment] = found
        return found

    def _segmented(self, text: str) -> list[str]:
        """Segments of a text that is not empty."""
        if self.apart and "  " not in text and text[0] != " " and SPACE not in text:
            # Without runs of spaces each space starts a segment.
            return (SPACE + text).replace(" ", " " + SPACE).split(" ")
        return self.segments((self.prefix + text).replace(" ", SPACE))

    def encode(self, text: str, add_eos: bool = False) -> tuple[list[int], str]:
        """Ids of a text, and the same in decimal, joined by spaces."""
        out = memoryview(b"".join(map(self.known.__getitem__, self._segmented(text)) if text else [])).cast("i").tolist()
        if add_eos:
            out.append(self.eos)
        return out, " ".join(map(self.spelled.__getitem__, out))


@lru_cache(maxsize=2)
def vocabulary(model_file: str) -> PieceVocabulary:
    return PieceVocabulary(model_file)


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _slices(texts: pa.Array, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Slices of a batch of about `most` characters, so that texts and ids in memory do not grow with the batch."""
    start = size = 0
    for i, length in enumerate(pc.fill_null(pc.utf8_length(texts), 0).to_pylist()):
        size += length
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


#: What `pieces` can return for a row.
OUTPUTS = {"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType(), "n_tokens": T.LongType(), "ids_sha256": T.StringType(),
           "decoded_sha256": T.StringType()}


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str | None = None,
           add_eos: bool = True, outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """Per row: id and the chosen OUTPUTS: token ids, the text that they decode to, their number, and digests of both.

    `model_file` is a path on every executor; by default the public 32k vocabulary is looked up there.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([source.schema["id"], *[T.StructField(name, OUTPUTS[name]) for name in outputs]])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_file or default_model())
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in batches:
            column = batch.column("text")
            for a, b in _slices(column):
                texts = [t or "" for t in column.slice(a, b - a).to_pylist()]
                # Nothing here makes cycles, and the collector would walk the remembered segments again and again.
                gc.disable()
                try:
                    found = [vocab.encode(t, add_eos) for t in texts]
                    ids = [x for x, _ in found]
                    vocab.verify(texts, ids, add_eos)
                finally:
                    gc.enable()
                decoded = vocab.library.decode(ids, num_threads=1)
                values = {"ids": lambda: pa.array(ids, pa.list_(pa.int32())), "decoded": lambda: pa.array(decoded, pa.string()),
                          "n_tokens": lambda: pa.array([len(x) for x in ids], pa.int64()),
                          "ids_sha256": lambda: pa.array([sha(x) for _, x in found]), "decoded_sha256": lambda: pa.array([sha(x) for x in decoded])}
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), *[values[name]() for name in outputs]], names=schema.names)

    return source.mapInArrow(encode, schema)


def op9_agenda_pieces(spark, sf_dir):
    found = pieces(table(spark, sf_dir, "documents"), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
    return found.withColumnRenamed("id", "doc_id")
