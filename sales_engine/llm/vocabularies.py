"""Places of the public vocabulary files. The folder is a parameter; the files are never copied."""

from __future__ import annotations

import os
from functools import partial


def folder() -> str:
    import public_tokenizers

    return os.path.dirname(public_tokenizers.__file__)


def byte_bpe(where: str | None = None):
    """Builder of the encoder of the 50k byte-level BPE vocabulary, to be called on the executors."""
    from public_tokenizers import PATTERN

    from sales_engine.llm.packing import Encoder

    where = where or folder()
    return partial(Encoder, f"{where}/byte_bpe_50k.json", f"{where}/byte_bpe_50k.tiktoken", PATTERN)


def pieces_model(where: str | None = None) -> str:
    """File of the 32k SentencePiece vocabulary with byte fallback."""
    return f"{where or folder()}/piece_bpe_32k.model"
