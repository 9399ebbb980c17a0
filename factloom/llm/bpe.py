"""Reading of public byte-level BPE files."""

from __future__ import annotations

import json
import os

#: Words given to the library at once.
AT_ONCE = 8_192


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def special_strings(path: str) -> list[str]:
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file)["added_tokens"]]
