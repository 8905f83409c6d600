"""Reading a SentencePiece model file: its pieces, normaliser flags and exact cut points."""

from __future__ import annotations

import re
import string
from dataclasses import dataclass, field

from kabuto.llm.common import kept

SPACE = "▁"  # how the models write a space
MAX_MODEL_BYTES = 64 << 20


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_model(path: str | None = None) -> bytes:
    """The model file's bytes (bounded: it is broadcast to the executors)."""
    with open(path or default_model_path(), "rb") as f:
        data = f.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError("the model file is too large to broadcast")
    return data


@dataclass
class Model:
    """A BPE model with byte fallback and the identity normaliser.

    ``rank`` maps a piece to its merge rank (0 is merged first), ``ids`` to its id, ``byte_ids``
    holds the id of each byte. ``surface`` holds what each id decodes to, as bytes.
    """

    ids: dict[str, int]
    rank: dict[str, int]
    byte_ids: list[int]
    surface: list[bytes]
    dummy_prefix: bool
    longest: int
    segments: re.Pattern | None
    prefixes: set[str] = field(default_factory=set)

    def normalise(self, text: str) -> str:
        """Identity normalisation: spaces become the space mark, a mark is put in front."""
        if not text:
            return ""
        out = text.replace(" ", SPACE)
        return SPACE + out if self.dummy_prefix else out

    def split(self, normalised: str) -> list[str]:
        """Segments whose encodings are independent of each other (see ``parse_model``)."""
        return self.segments.findall(normalised) if self.segments else [normalised]


def parse_model(data: bytes) -> Model:
    """Parse a model file. Raises ValueError for kinds of model that aren't supported.

    Merges never cross a cut between two characters that no piece holds side by side. Three kinds
    of cut are checked against the vocabulary and used to split texts: before a space mark that
    follows another character, around line feeds, and between a word of letters and digits
    and a punctuation mark behind it.
    """
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(data)
    norm = proto.normalizer_spec
    if proto.trainer_spec.model_type != pb.TrainerSpec.BPE or not proto.trainer_spec.byte_fallback:
        raise ValueError("only BPE models with byte fallback are supported")
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
        raise ValueError("only the identity normaliser is supported")
    kind = pb.ModelProto.SentencePiece
    ids, scores, byte_ids, surface = {}, {}, [0] * 256, []
    for i, p in enumerate(proto.pieces):
        if p.type == kind.BYTE:
            byte = int(p.piece[3:5], 16)
            byte_ids[byte] = i
            surface.append(bytes([byte]))
        elif p.type == kind.NORMAL:
            ids[p.piece] = i
            scores[p.piece] = p.score
            surface.append(p.piece.replace(SPACE, " ").encode())
        elif p.type in (kind.UNKNOWN, kind.CONTROL):
            surface.append(proto.trainer_spec.unk_surface.encode() if p.type == kind.UNKNOWN else b"")
        else:
            raise ValueError("user-defined and unused pieces are not supported")
    order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
    if any(c not in ids for p in ids for c in p):
        raise ValueError("a piece holds a character that is no piece")
    pairs = {p[k : k + 2] for p in ids for k in range(len(p) - 1)}
    cut = not any(b == SPACE != a or "\n" in (a, b) for a, b in pairs)
    joined = {b for a, b in pairs if a.isalnum()}
    marks = re.escape("".join(c for c in string.punctuation if c not in joined))
    words = f"{SPACE}*[^\\W_]+(?=[{marks}{SPACE}\n]|$)|" if marks else ""
    return Model(
        ids=ids,
        rank={p: order[s] for p, s in scores.items()},
        byte_ids=byte_ids,
        surface=surface,
        dummy_prefix=norm.add_dummy_prefix,
        longest=max(map(len, ids)),
        segments=re.compile(f"{words}{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n") if cut else None,
        prefixes={p[:k] for p in ids for k in range(1, len(p) + 1)},
    )


def model_of(data: bytes) -> Model:
    """The parsed model, once per Python worker."""
    import hashlib

    key = hashlib.sha256(data).digest()
    mine = kept("pieces")
    if key not in mine:
        mine[key] = parse_model(data)
    return mine[key]
