"""The pieces of a SentencePiece model and an Aho-Corasick automaton over them.

A model file is read as a unigram lexicon: its pieces with its own scores. A file of another type (BPE, whose scores are the
negative ranks of the merges) is read the same way, so that the best segmentation is the one of the smallest sum of ranks;
it is not that type's own merge procedure. Scores are summed exactly, in double precision.
"""

from __future__ import annotations

import re

import ahocorasick
from sentencepiece import sentencepiece_model_pb2 as proto

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
UNKNOWN_PENALTY = 10.0
USER_BONUS = 0.1


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Lexicon:
    def __init__(self, path: str) -> None:
        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.normalizer_spec.precompiled_charsmap:
            raise ValueError("only models without a character map are supported")
        self.prefix = model.normalizer_spec.add_dummy_prefix
        self.collapse = model.normalizer_spec.remove_extra_whitespaces
        self.pieces = [p.piece for p in model.pieces]
        kinds = [p.type for p in model.pieces]
        self.unknown = kinds.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == BYTE}
        scores = [p.score for p in model.pieces]
        normal = [s for s, k in zip(scores, kinds) if k == NORMAL]
        self.unknown_score = min(normal) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        self.singles = set()
        for i, (piece, score, kind) in enumerate(zip(self.pieces, scores, kinds)):
            if kind in (NORMAL, USER_DEFINED) and piece:
                bonus = len(piece.encode()) * max(normal) - USER_BONUS
                self.automaton.add_word(piece, (i, bonus if kind == USER_DEFINED else score, len(piece)))
                if len(piece) == 1:
                    self.singles.add(piece)
        self.automaton.make_automaton()
        # Where no piece runs into a word from before, the best path of a text is that of its words one after the other.
        used = [p for p, k in zip(self.pieces, kinds) if k in (NORMAL, USER_DEFINED)]
        words = not any(re.search(f"[^{SPACE}]{SPACE}|.\n|\n.", p, re.S) for p in used)
        self.chunk = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n" if words else r".+", re.S)
        # What each id stands for in decoded text.
        self.plain = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for value, i in self.bytes.items():
            self.plain[i] = bytes([value])
        for i, kind in enumerate(kinds):
            if kind == CONTROL:
                self.plain[i] = b""
            elif kind == UNKNOWN:
                self.plain[i] = (model.trainer_spec.unk_surface or " ⁇ ").encode()

    def chunks(self, text: str) -> list[str]:
        """The normalized text, cut where no piece can cross."""
        if self.collapse:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return []
        text = text.replace(" ", SPACE)
        return self.chunk.findall(SPACE + text if self.prefix else text)

    def fallback(self, char: str) -> list[int]:
        """The ids of a character that no piece covers."""
        return [self.bytes[b] for b in char.encode()] if self.bytes else [self.unknown]


_lexicons: dict[str, Lexicon] = {}


def lexicon_of(path: str) -> Lexicon:
    """One lexicon per worker process, kept between tasks."""
    if path not in _lexicons:
        _lexicons[path] = Lexicon(path)
    return _lexicons[path]
