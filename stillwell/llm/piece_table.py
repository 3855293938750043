"""The tables of a SentencePiece BPE model, and encoding by last tokens of prefixes.

Every prefix of a text has one encoding, and what stands before its last token is the encoding of
the shorter prefix. So each prefix needs no more than its last token: of the pieces that end there,
found by an automaton, it is the one that may stand behind the last token of the prefix before it.
Two tokens may stand together if the merges of their joint text never cross the border, which the
merges that made their edges tell. Ids are recovered backwards from the whole text's last token.
"""

import re
from array import array
from itertools import groupby

import numpy as np

SPACE = "▁"
KNOWN_PAIRS, KNOWN_WORDS, LONGEST_KNOWN = 1_000_000, 200_000, 64


def merged(symbols: list[str], rank: dict[str, float]) -> tuple[list[str], dict]:
    """Symbols after all merges, best rank first and leftmost among equals, and the parts of each
    merged piece."""
    parts: dict[str, tuple[str, str]] = {}
    while True:
        found = min(((rank[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))
                     if a + b in rank), default=None)
        if found is None:
            return symbols, parts
        i = found[1]
        a, b = symbols[i:i + 2]
        parts[a + b] = (a, b)
        symbols = [*symbols[:i], a + b, *symbols[i + 2:]]


class PieceTable:
    """What encoding and decoding need of a model file; bounded by the vocabulary."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds, spec = sentencepiece_model_pb2.ModelProto.SentencePiece, model.normalizer_spec
        if (model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback
                or spec.precompiled_charsmap or spec.remove_extra_whitespaces
                or not spec.add_dummy_prefix or not spec.escape_whitespaces
                or model.trainer_spec.treat_whitespace_as_suffix
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)):
            raise ValueError("a BPE model with byte fallback and plain texts is needed")
        self.end = next(i for i, p in enumerate(model.pieces) if p.piece == "</s>")
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        score = {p: model.pieces[i].score for p, i in normal.items()}
        order = {s: n for n, s in enumerate(sorted(set(score.values()), reverse=True))}
        rank = {p: order[s] for p, s in score.items() if len(p) > 1}
        self.bytes = [0] * 256
        self.surface: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
            self.surface.append(
                bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE
                else b"" if p.type == kinds.CONTROL
                else model.trainer_spec.unk_surface.encode() if p.type == kinds.UNKNOWN
                else p.piece.replace(SPACE, " ").encode())
        self.spaced = np.array([p.type == kinds.NORMAL and p.piece.startswith(SPACE)
                                for p in model.pieces])
        #: Words are encoded apart where no piece holds a space behind another character.
        self.by_words = not any(SPACE in p.lstrip(SPACE) for p in normal)

        # Pieces that merges reach, with the parts of their last merge.
        self.pieces: dict[str, int] = {}
        self.lengths, self.ranks = [0] * len(model.pieces), [-1] * len(model.pieces)
        self.parts: list[tuple[int, int] | None] = [None] * len(model.pieces)
        for piece, i in normal.items():
            symbols, parts = merged(list(piece), rank)
            if len(symbols) > 1:
                continue
            self.pieces[piece], self.lengths[i] = i, len(piece)
            if len(piece) > 1:
                first, second = parts[piece]
                if not (first in normal and second in normal):
                    raise ValueError(f"parts of {piece!r} are no pieces")
                self.parts[i], self.ranks[i] = (normal[first], normal[second]), rank[piece]
                if rank[piece] < max(rank.get(first, -1), rank.get(second, -1)):
                    raise ValueError(f"{piece!r} comes before its parts")
        self.joint = {}
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                a, b = normal.get(piece[:cut]), normal.get(piece[cut:])
                if a is not None and b is not None:
                    self.joint[a, b] = rank[piece]

    def together(self, first: int, second: int) -> bool:
        """Whether merges of the joint text end in just these two tokens.

        The last merges are taken back, latest first (of equals the right one, as merges go from
        the left), which gives the symbols that once met at the border. They would have merged if
        their joint piece comes before the merge taken back; among equals the left one comes first.
        """
        joint, ranks, parts = self.joint, self.ranks, self.parts
        before = float("inf")  # joint pieces of a lower rank would have merged
        while True:
            if joint.get((first, second), before) < before:
                return False
            if ranks[first] > ranks[second]:
                before, first = ranks[first], parts[first][1]
            elif parts[second] is not None:
                before, second = ranks[second] + 0.5, parts[second][0]
            else:
                return True


class Words(dict):
    """Ids of words met lately; when ``KNOWN_WORDS`` are held, as many older ones are forgotten."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = array("i", self.encode(SPACE + word.replace(" ", SPACE))).tobytes()
        if len(word) <= LONGEST_KNOWN:
            if len(self) >= KNOWN_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Encodes texts in a task; keeps bounded memories of pairs and words."""

    def __init__(self, table: PieceTable):
        import ahocorasick

        self.table, self.pairs, self.words = table, {}, Words(self.word)
        self.automaton = ahocorasick.Automaton()
        for piece, i in table.pieces.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.cut = re.compile(" ( *[^ ]+| *$)")

    def ids(self, text: str) -> bytes:
        """Ids of a text, without an end, as 32-bit words."""
        if not text:
            return b""
        text = text.replace(SPACE, " ")
        if not self.table.by_words:
            words = [text]
        elif "  " in text or text[-1] == " " or text[0] == " ":
            words = self.cut.findall(" " + text)  # a run of spaces belongs to the word behind it
        else:
            words = text.split(" ")
        return b"".join(map(self.words.__getitem__, words))

    def word(self, word: str) -> list[int]:
        lengths, pairs, together = self.table.lengths, self.pairs, self.table.together
        if len(pairs) >= KNOWN_PAIRS:
            pairs.clear()
        last = [0] * (len(word) + 1)  # the last token of each prefix; pieces are never id 0
        for at, piece in self.automaton.iter(word):
            if last[at + 1]:
                continue
            start = at + 1 - lengths[piece]
            if start:
                before = last[start]
                if not before:
                    continue
                pair = before, piece
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs[pair] = together(before, piece)
                if not fits:
                    continue
            last[at + 1] = piece
        out, at = [], len(word)
        while at:
            if not last[at]:
                return self.with_unknown(word)
            out.append(last[at])
            at -= lengths[last[at]]
        return out[::-1]

    def with_unknown(self, word: str) -> list[int]:
        """No piece holds a letter that is no piece itself: it becomes its bytes."""
        out, pieces, of_byte = [], self.table.pieces, self.table.bytes
        for known, part in groupby(word, pieces.__contains__):
            part = "".join(part)
            out += self.word(part) if known else [of_byte[b] for b in part.encode()]
        return out


def whole_letters(data: bytes) -> str:
    """Bytes as text; each byte that belongs to no letter becomes one replacement mark."""
    out = []
    while True:
        try:
            return "".join(out) + data.decode()
        except UnicodeDecodeError as bad:
            out += data[:bad.start].decode(), "�"
            data = data[bad.start + 1:]
