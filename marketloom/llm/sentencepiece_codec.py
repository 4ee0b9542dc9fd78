"""SentencePiece models run by the tokenizers library: encode, decode, and proof that both libraries agree."""

from __future__ import annotations

import os
import re
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import kept_by_worker, map_text

SPACE = "▁"
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Kinds of pieces and models in the protobuf (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Distinct parts that a worker keeps encoded before it drops those it does not need now, and that it gives to the libraries at once.
CACHE, AT_ONCE = 150_000, 5_000


@dataclass(frozen=True)
class Codec:
    """`model` is the whole protobuf; `threads` run in one batch of the tokenizers library."""

    model: bytes
    threads: int = 2

    @staticmethod
    def load(path: str = MODEL_PATH, threads: int = 2) -> Codec:
        with open(path, "rb") as f:
            return Codec(f.read(), threads)


class Machine:
    """A parsed model: normaliser, tokenizers backend without prefix handling, and byte string of every piece."""

    def __init__(self, codec: Codec):
        os.environ["RAYON_NUM_THREADS"] = str(codec.threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if codec.threads > 1 else "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as protobuf
        from tokenizers import Tokenizer, models

        proto = protobuf.ModelProto()
        proto.ParseFromString(codec.model)
        pieces = [(p.piece, p.score, p.type) for p in proto.pieces]
        self.byte_fallback = proto.trainer_spec.byte_fallback
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        self.unknown_surface = proto.trainer_spec.unk_surface
        plain = [p for p in pieces if p[2] == NORMAL]
        if proto.trainer_spec.model_type == BPE:
            # Only normal pieces come about by merging; the rank of a merge is the score of what it makes.
            backend = models.BPE(
                {p[0]: i for i, p in enumerate(pieces)},
                _merges(plain),
                unk_token=pieces[self.unknown][0],
                fuse_unk=True,
                byte_fallback=self.byte_fallback,
            )
        elif proto.trainer_spec.model_type == UNIGRAM:
            # Pieces that text may never become score below any path.
            scores = [(p, s if kind in (NORMAL, USER_DEFINED) else -1e9) for p, s, kind in pieces]
            backend = models.Unigram(scores, self.unknown, self.byte_fallback)
        else:
            raise ValueError("only unigram and BPE models are rebuilt")
        self.tokenizer = Tokenizer(backend)
        self.cut = _cut(plain, proto.trainer_spec.model_type, any(p[2] == USER_DEFINED for p in pieces))
        # One reference for the text, another for its parts, which are normalised already.
        self.text_reference = sentencepiece.SentencePieceProcessor(model_proto=codec.model)
        self.spec = type(proto.normalizer_spec).FromString(proto.normalizer_spec.SerializeToString())
        proto.normalizer_spec.name = "identity"
        proto.normalizer_spec.precompiled_charsmap = b""
        proto.normalizer_spec.add_dummy_prefix = False
        proto.normalizer_spec.remove_extra_whitespaces = False
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.normaliser = self._normaliser()
        self.bytes_of = [self._bytes(i, p) for i, p in enumerate(pieces)]
        self.known: dict[str, bytes] = {}
        self.repaired: set[str] = set()

    def _normaliser(self):
        from tokenizers import Regex, normalizers

        steps = []
        if self.spec.precompiled_charsmap:
            steps.append(normalizers.Precompiled(self.spec.precompiled_charsmap))
        if self.spec.remove_extra_whitespaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        return normalizers.Sequence(steps) if steps else None

    def _bytes(self, i: int, piece: tuple[str, float, int]) -> bytes:
        text, _, kind = piece
        if kind == BYTE:
            return bytes([int(text[3:-1], 16)])
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return self.unknown_surface.encode()
        return text.replace(SPACE, " ").encode()

    def normalise(self, text: str) -> str:
        if self.normaliser:
            text = self.normaliser.normalize_str(text)
        if text and self.spec.add_dummy_prefix:
            text = " " + text
        return text.replace(" ", SPACE) if self.spec.escape_whitespaces else text

    def normalised(self, text: str) -> tuple[str, bool]:
        """The text as the rebuilt normaliser makes it, held against the unchanged model's own wherever the model
        changes characters or spaces. Where the two differ, the model's is taken and the text counts as repaired."""
        ours = self.normalise(text)
        if self.normaliser is None:
            return ours, False
        theirs = self.text_reference.normalize(text)
        return theirs, theirs != ours

    def encode_parts(self, parts: set[str]) -> None:
        """Encode new distinct parts in multithreaded batches and hold each against the reference library.
        Where the two differ, the reference's ids replace those of the backend and the part counts as repaired."""
        new = [p for p in parts if p not in self.known]
        if len(self.known) + len(new) > CACHE:
            self.known = {p: self.known[p] for p in parts if p in self.known}
            self.repaired.intersection_update(self.known)
        for at in range(0, len(new), AT_ONCE):
            some = new[at : at + AT_ONCE]
            ours = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            theirs = self.reference.encode(some, num_threads=1)
            for part, a, b in zip(some, ours, theirs, strict=True):
                ids = a.ids
                if ids != b:
                    ids = b
                    self.repaired.add(part)
                elif self.repaired:
                    self.repaired.discard(part)
                self.known[part] = array("i", ids).tobytes()

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[int], list[str]]:
        """Ids (32 bits each), repaired parts (the normaliser's included) and normalised form of each whole text."""
        forms = [self.normalised(t) if t else ("", False) for t in texts]
        split = [self.cut.findall(form) if form else [] for form, _ in forms]
        self.encode_parts(set().union(*split))
        wrong = self.repaired
        repaired = [int(fixed) + (sum(p in wrong for p in parts) if wrong else 0) for parts, (_, fixed) in zip(split, forms, strict=True)]
        return [b"".join(map(self.known.__getitem__, parts)) for parts in split], repaired, [form for form, _ in forms]

    def decode(self, ids: list[int]) -> str:
        """Text of `ids`: pieces and fallback bytes joined, the added first space taken away."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return raw[1:] if self.spec.add_dummy_prefix and raw.startswith(" ") else raw


def _merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score first; of one piece, in order of its cut."""
    score = {p: s for p, s, _ in pieces}
    made = [(-s, p) for p, s in score.items() if len(p) > 1]
    made.sort(key=lambda x: x[0])
    return [(p[:i], p[i:]) for _, p in made for i in range(1, len(p)) if p[:i] in score and p[i:] in score]


def _cut(pieces: list[tuple[str, float, int]], kind: int, special: bool) -> re.Pattern:
    """Pattern of the parts that can be encoded each on its own: no piece reaches over their borders.

    Between a character and a following space mark, if no piece has a mark after another character; around
    line breaks, if no piece has one. A model where that does not hold is given whole texts.
    """
    crossing = special or any(SPACE in p.lstrip(SPACE) for p, _, _ in pieces)
    if crossing:
        return re.compile(r"(?s).+")
    lines = "" if any("\n" in p for p, _, _ in pieces) else "\n"
    parts = f"{SPACE}+[^{SPACE}{lines}]*|[^{SPACE}{lines}]+"
    return re.compile(parts + ("|\n+" if lines else ""))


@lru_cache(maxsize=2)
def machine(codec: Codec) -> Machine:
    """One parsed model per worker."""
    return Machine(codec)


#: Models and the ids of known parts stay in a worker for the next task that encodes or decodes, not for other work.
KEPT = "sentencepiece"
kept_by_worker[KEPT] = machine.cache_clear


def encode_documents(docs: DataFrame, codec: Codec) -> DataFrame:
    """doc_id, ids, n_tokens, n_repaired and round_trip for every row of `docs`; no shuffle.

    Whole texts count. round_trip says that the ids decode to the normalised text, byte for byte. Null and
    empty texts have no ids; repeated rows each get theirs; an empty table gives no rows. The ids are those of the
    tokenizers backend. Every distinct part is encoded by both libraries, n_repaired counts the parts of a text where they
    differed and the reference's ids were taken instead (0: full parity). Columns but doc_id and text are not read.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = machine(codec)
        texts = batch.column(1).to_pylist()
        ids, repaired, forms = own.encode(texts)
        arrays = [np.frombuffer(x, np.int32) for x in ids]
        whole = [
            not form or own.decode(a.tolist()) == form.replace(SPACE, " ")[int(own.spec.add_dummy_prefix) :]
            for form, a in zip(forms, arrays, strict=True)
        ]
        counts = np.array([len(a) for a in arrays], np.int64)
        ends = np.zeros(len(arrays) + 1, np.int32)
        np.cumsum(counts, out=ends[1:])
        flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                pa.array(counts, pa.int64()),
                pa.array(repaired, pa.int64()),
                pa.array(whole, pa.bool_()),
            ],
            names=["doc_id", "ids", "n_tokens", "n_repaired", "round_trip"],
        )

    schema = f"doc_id {kind}, ids array<int>, n_tokens long, n_repaired long, round_trip boolean"
    return map_text(docs.select("doc_id", "text"), work, schema, keep=KEPT)


def decode_documents(encoded: DataFrame, codec: Codec) -> DataFrame:
    """doc_id and text of every row of `encoded` (doc_id, ids); null ids give null, empty ones the empty text."""
    kind = dict(encoded.dtypes)["doc_id"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = machine(codec)
        texts = [None if ids is None else own.decode(ids) for ids in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_text(encoded.select("doc_id", F.col("ids").cast("array<int>")), work, f"doc_id {kind}, text string", keep=KEPT)
