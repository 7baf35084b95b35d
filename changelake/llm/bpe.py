"""Operator 5, BPE encoding and decoding with a given vocabulary file.

Encoding is a transducer with bounded lookahead. Merges run in rank order, so two texts that
agree up to some point can only be cut differently near that point: a merge across it takes
the token that ends there, a later merge may then take the one before, and so on, with rising
ranks. ``sufficient_lookahead`` finds the longest such chain of the merge list. Tokens that
end further than that from the end of what has been read are stable and leave the buffer, so
a word of any length needs constant memory. Decoding reads ids one by one: as the library
does without a decoder (token strings, one space between), or back to text, where bytes of an
unfinished character wait in a small state machine.

The vocabulary is read on the driver and its merges travel to the tasks (a few MB, bounded by
the file). Pieces seen before come from two dictionaries of a fixed size, the older dropped whole.

Defined cases: a null text is empty and gives no tokens; special tokens inside a text get
their own id, as in the library; repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.store import table

VOCABULARY = "word_bpe_49k.json"
END = "</w>"
REMEMBERED_PIECES = 1 << 18
#: Fixed value: how this vocabulary cuts text into pieces; whatever matches nothing is dropped.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = dict.fromkeys(range(256), "") | {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if not letters[b]):
        letters[b] = chr(256 + k)
    return [letters[b] for b in range(256)]


def load(path: str) -> dict:
    """The parts of a vocabulary file that encoding and decoding need."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    return {"vocab": file["model"]["vocab"], "merges": [tuple(m) for m in file["model"]["merges"]],
            "special": {t["content"]: t["id"] for t in file["added_tokens"]}}


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols beyond which text cannot change a token.

    If a merge (u, v) across the point where two texts part happens in one of them only, the
    point moves left by u. The next such merge has a higher rank, and its right side starts
    with the u just taken. The result is the longest sum of the u's over such chains.
    """
    reach: dict[str, int] = {}
    most = 0
    for left, right in merges:
        right = right.removesuffix(END)
        best = len(left) + max((reach.get(right[:k], 0) for k in range(1, len(right) + 1)), default=0)
        reach[left] = max(reach.get(left, 0), best)
        most = max(most, best)
    return most


class Encoder:
    """Text to ids. ``lookahead`` and the buffer size follow from the merge list."""

    def __init__(self, vocabulary: dict):
        vocab = vocabulary["vocab"]
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.final = [vocab[c + END] for c in letters]
        self.pairs = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(vocabulary["merges"])}
        self.lookahead = sufficient_lookahead(vocabulary["merges"])
        self.buffer = 2 * self.lookahead + 64
        self.length = {i: len(t.removesuffix(END)) for t, i in vocab.items()}
        self.special = vocabulary["special"]
        self.specials = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        self.pieces = regex.compile(PIECES)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _merged(self, ids: list[int]) -> list[int]:
        """Merges the lowest-ranked pair, the leftmost of equals first, until none is left."""
        pairs = self.pairs
        while len(ids) > 1:
            best, at = None, []
            for k, found in enumerate(map(pairs.get, zip(ids, ids[1:]))):
                if found is not None:
                    if best is None or found[0] < best[0]:
                        best, at = found, [k]
                    elif found[0] == best[0]:
                        at.append(k)
            if best is None:
                break
            out, k = [], 0
            places = set(at)
            while k < len(ids):
                if k in places:
                    out.append(best[1])
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        return ids

    def stream(self, symbols: Iterable[int]) -> Iterator[int]:
        """Ids of one piece given as bytes, each emitted once it is stable."""
        held: list[int] = []
        for b in symbols:
            held.append(b)
            if len(held) > self.buffer:
                # one symbol stays back, since the last of a piece has a form of its own
                ids = self._merged([self.inner[c] for c in held[:-1]])
                done = 0
                for token in ids:
                    if done + self.length[token] > len(held) - 1 - self.lookahead:
                        break
                    done += self.length[token]
                    yield token
                del held[:done]
        if held:
            yield from self._merged([*(self.inner[c] for c in held[:-1]), self.final[held[-1]]])

    def piece(self, piece: str) -> bytes:
        raw = piece.encode()
        if len(self.known) >= REMEMBERED_PIECES:
            self.known, self.older = {}, self.known
        if piece in self.older:
            self.known[piece] = self.older[piece]
            return self.known[piece]
        if len(raw) <= self.buffer:
            ids = self._merged([*(self.inner[c] for c in raw[:-1]), self.final[raw[-1]]])
            out = np.array(ids, dtype="<u4").tobytes()
            self.known[piece] = out
            return out
        return np.fromiter(self.stream(raw), dtype="<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case letter by letter
        pieces = self.pieces.findall(text.lower())
        return b"".join([self.known.get(p) or self.piece(p) for p in pieces])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.specials is None or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._plain(p)
                        for p in self.specials.split(text) if p)


class Decoder:
    """Ids to text, one id at a time."""

    def __init__(self, vocabulary: dict):
        names = {i: t for t, i in vocabulary["vocab"].items()} | {i: t for t, i in vocabulary["special"].items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.bytes = {c: b for b, c in enumerate(byte_letters())}
        self.special = set(vocabulary["special"].values())

    def tokens(self, ids: bytes) -> str:
        """Token strings with one space between them, as the library joins them for a
        vocabulary file that names no decoder."""
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])

    def text(self, ids: bytes) -> Iterator[str]:
        """Readable text, emitted as soon as its bytes form whole characters; a word end
        becomes a space, a byte that starts no character becomes U+FFFD."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        for i in np.frombuffer(ids, dtype="<u4").tolist():
            name = self.names[i]
            if i in self.special:
                yield state.decode(b"", True) + name
                state.reset()
                continue
            body = name.removesuffix(END)
            yield state.decode(bytes(self.bytes[c] for c in body)) + (" " if len(body) < len(name) else "")
        yield state.decode(b"", True)


_ready: dict[int, tuple[Encoder, Decoder]] = {}


def _coders(shared) -> tuple[Encoder, Decoder]:
    """One pair for each Python worker and vocabulary; its pieces stay known between tasks."""
    if shared.id not in _ready:
        _ready.clear()
        _ready[shared.id] = (Encoder(shared.vocabulary), Decoder(shared.vocabulary))
    return _ready[shared.id]


class _Shared:
    """A broadcast vocabulary and its name."""

    def __init__(self, name: str, broadcast):
        self.id, self.broadcast = name, broadcast

    @property
    def vocabulary(self) -> dict:
        return self.broadcast.value


OUTPUT = {"doc_id": "long", "n_tokens": "long", "ids": "binary", "decoded": "string", "ids_sha256": "string",
          "decoded_sha256": "string"}


def code(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         output: tuple[str, ...] = tuple(OUTPUT)) -> DataFrame:
    """doc_id, n_tokens, the ids (binary), their decoded form and the SHA-256 of both, or
    those of them named in ``output``."""
    shared = _Shared(path, docs.sparkSession.sparkContext.broadcast(load(path)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _coders(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # bounded output batches
                part = batch.slice(at, 256)
                ids = [encoder.encode(t) for t in part.column(1).to_pylist()]
                texts = [decoder.tokens(i) for i in ids]
                columns = {"doc_id": lambda: part.column(0), "n_tokens": lambda: pa.array([len(i) // 4 for i in ids], pa.int64()),
                           "ids": lambda: pa.array(ids, pa.binary()), "decoded": lambda: pa.array(texts, pa.string()),
                           "ids_sha256": lambda: pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                           "decoded_sha256": lambda: pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())}
                yield pa.RecordBatch.from_arrays([columns[c]() for c in output], names=list(output))

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(task, ", ".join(f"{c} {OUTPUT[c]}" for c in output)))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def query(spark, sf_dir: str) -> DataFrame:
    return code(table(spark, sf_dir, "documents"), vocabulary_path(),
                output=("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))
