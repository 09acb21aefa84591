"""Token ids of whole texts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import functools

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

TOKENIZER = "byte_bpe_50k.json"
END_OF_TEXT = "<|endoftext|>"


class Encoder:
    """The ids that the ``tokenizers`` library gives for a file of byte-level BPE.

    The same vocabulary lies beside it as ranks, which ``tiktoken`` turns into the
    same ids several times faster; a text that it cannot take goes to ``tokenizers``.
    """

    def __init__(self, path: str) -> None:
        self.slow = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        special = {END_OF_TEXT: self.slow.token_to_id(END_OF_TEXT)}
        self.fast = tiktoken.Encoding(
            "public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )

    def ids(self, text: str | None, special: bool = True) -> np.ndarray:
        """Unsigned 32-bit ids, without special tokens at the ends; none of a null. The
        string of a special token in a text is that token, or ordinary text if not ``special``."""
        if not text:
            return np.zeros(0, np.uint32)
        try:
            allowed, refused = ("all" if special else set()), ()
            return np.asarray(self.fast.encode_to_numpy(text, allowed_special=allowed, disallowed_special=refused), np.uint32)
        except BaseException as error:  # a panic of the extension is no Exception
            if isinstance(error, KeyboardInterrupt | SystemExit):
                raise
            slow = self.slow if special else self.plain
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)


@functools.lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path or public_tokenizers.path(TOKENIZER))
