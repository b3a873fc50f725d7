"""The pieces of a SentencePiece model, read on the driver and shipped to tasks (a vocabulary is bounded)."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

#: The path is a parameter of every operator; this is its default.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: How pieces write a space.
MARK = "▁"
#: Pieces begin at spaces and no piece holds a line feed, so texts may be cut there.
SEGMENT = re.compile(r" *[^ \n]+| +|\n")
#: Segments whose results a task keeps.
CACHE = 1_000_000


@dataclass(frozen=True)
class Vocabulary:
    """``ids`` and ``scores`` of ordinary pieces (a space is a space here), ids of the 256 bytes, all pieces by id."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_: tuple[int, ...]
    pieces: tuple[str, ...] = field(repr=False)

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids, scores, bytes_, pieces = {}, {}, [0] * 256, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            pieces.append(piece.replace(MARK, " "))
            if model.is_byte(i):
                bytes_[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                ids[pieces[-1]], scores[pieces[-1]] = i, model.get_score(i)
        if not any(bytes_) or any("\n" in p or re.search("[^ ] ", p) for p in ids):
            raise ValueError("a vocabulary with byte pieces, without line feeds and with spaces in front alone is needed")
        return cls(ids, scores, tuple(bytes_), tuple(pieces))


def segments(text: str) -> list[str]:
    """The segments of a text with the space that the tokenizer puts in front; an empty text has none."""
    return SEGMENT.findall(" " + text) if text else []
