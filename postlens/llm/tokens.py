"""Token ids of whole texts by the tokenizers library, each distinct chunk being encoded once."""

import json
import os
import re
import weakref
from array import array

from postlens.llm.common import per_worker

# A space beside other white space belongs to a longer run, which must stay whole.
RUN_WITH_SPACE = re.compile(r"\s | \s")
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
SEGMENT_CHARS = 1 << 20
CACHED_CHARS = 1 << 22
MARKS = ".,;:!?#*$%&|<>"
KEPT_MARKS = 10_000


class Known(dict):
    """Ids by chunk; a chunk not known is encoded and kept.

    There are two generations of so many characters: when the young one is full it becomes the old one, and chunks met
    again move back. So memory is bounded and frequent chunks stay.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode, self.chars, self.old = encode, 0, {}

    def __missing__(self, chunk):
        ids = self.old.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        if self.chars > CACHED_CHARS:
            # The old generation goes before the young one is copied, so no third one is held.
            self.old = None
            self.old, self.chars = dict(self), 0
            self.clear()
        self[chunk] = ids
        self.chars += len(chunk)
        return ids

    def find(self, chunk):
        """The ids of a chunk that is known, None for others."""
        return self.get(chunk) or self.old.get(chunk)


class ChunkEncoder:
    """Whole texts to ids, as little-endian unsigned 32-bit bytes.

    The pre-tokenizers used here never join what stands before a lone space with what follows it, so
    ids of a text are those of its chunks in order. encode_tail gets a chunk that has a space in front of it, without
    the space; encode_head gets the first one.
    """

    def __init__(self, encode_head, encode_tail, keep_spaces):
        self.encode_head, self.keep_spaces = encode_head, keep_spaces
        self.known = Known(encode_tail)

    def chunks(self, text):
        if not self.keep_spaces:
            # White space is only a border here, so a line feed parts chunks as a space does.
            return text.replace("\n", " ").split(" ")
        if not RUN_WITH_SPACE.search(text):
            return text.split(" ")
        return LONE_SPACE.split(text)

    def segments(self, text):
        start = 0
        while len(text) - start > SEGMENT_CHARS:
            cut = LONE_SPACE.search(text, start + SEGMENT_CHARS)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.end()
        yield text[start:]

    def __call__(self, text):
        ids = []
        for place, segment in enumerate(self.segments(text or "")):
            chunks = self.chunks(segment)
            if place == 0:
                ids.append(self.encode_head(chunks.pop(0)))
            ids.append(b"".join(map(self.known.__getitem__, chunks)))
        return b"".join(ids)


def byte_letters():
    """The letter that stands for each byte in a byte-level vocabulary file.

    Printable Latin-1 bytes stand for themselves, the rest for the letters from U+0100 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {byte: chr(byte) for byte in printable}
    for byte in range(256):
        letters.setdefault(byte, chr(256 + len(letters) - len(printable)))
    return letters


def packed(ids):
    return array("I", ids).tobytes()


class LibraryChunks:
    """Ids of chunks by the library.

    Latin-1 letters, with marks like full stops and commas after them, are one or two pre-tokens in any of the
    pre-tokenizers used here, so the letters go to the library's model at once, unless they are a chunk that is known.
    Other chunks take the whole way.
    """

    def __init__(self, spec, keep_spaces):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        steps = (json.loads(spec)["normalizer"] or {}).get("normalizers", [])
        self.lowers = any(step["type"] == "Lowercase" for step in steps)
        self.space = " " if keep_spaces else ""
        letters = byte_letters()
        self.space_letter = letters[32] if keep_spaces else ""
        self.letters = {byte: letter for byte, letter in letters.items()}
        self.marks = {"": b""}
        self.known = None

    def whole(self, text):
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def tail(self, chunk):
        body = chunk.rstrip(MARKS)
        if not body.isalpha() or not (body.isascii() or max(body) <= "\xff"):
            return self.whole(self.space + chunk)
        marks = chunk[len(body) :]
        text = body.lower() if self.lowers else body
        ids = None if self.known is None else self.known.find(text)
        if ids is None:
            if not text.isascii():
                text = text.encode("utf-8").decode("latin-1").translate(self.letters)
            ids = packed([token.id for token in self.tokenize(self.space_letter + text)])
        if marks:
            if marks not in self.marks:
                if len(self.marks) > KEPT_MARKS:
                    self.marks.clear()
                self.marks[marks] = self.whole(marks)
            ids += self.marks[marks]
        return ids


def library_encoder(spec: str, keep_spaces: bool) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file's content."""

    def make():
        library = LibraryChunks(spec, keep_spaces)
        encoder = ChunkEncoder(library.whole, library.tail, keep_spaces)
        # No cycle, so that per_worker can let go of it at once.
        library.known = weakref.proxy(encoder.known)
        return encoder

    return per_worker(("library", hash(spec), keep_spaces), make)


def file_text(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()
