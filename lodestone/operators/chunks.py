"""Chunks of bounded length that end at paragraphs, lines or sentences where they can, and overlap.

The last end of each kind is searched backwards from the full length, so that a chunk costs a few searches
however far its end is; columns cut their texts in Python workers, batch by batch.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The marks that a chunk may end with, best kinds first; those of a kind have one width.
ENDS = [("\n\n",), ("\n",), (". ", ".\n", ";\n", "}\n")]


def cut(text: str, most: int, overlap: int, window: int = 2000) -> list[str]:
    """The chunks of a text; one that is not over ``most`` characters is a chunk as it is.

    An end counts if its mark starts in the chunk's last ``window`` characters and behind its middle; the next
    chunk starts ``overlap`` characters before the end, at least one on.
    """
    if len(text) <= most:
        return [text]
    least, start, out = max(most - window, most // 2 + 1), 0, []
    while True:
        end = start + most
        if end >= len(text):
            end = len(text)
        else:
            for marks in ENDS:
                at = max(text.rfind(m, start + least, end) for m in marks)
                if at >= 0:
                    end = at + len(marks[0])
                    break
        if chunk := text[start:end].strip():
            out.append(chunk)
        if end == len(text):
            return out or [text[:most]]
        start = max(start + 1, end - overlap)


def chunks(text: Column, most: int, overlap: int, window: int = 2000) -> Column:
    """Array of the chunks of a text; a null or empty text has one empty chunk."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([cut(t, most, overlap, window) for t in texts])

    return F.pandas_udf(run, "array<string>")(F.coalesce(text, F.lit("")))
