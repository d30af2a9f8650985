"""Image dimensions out of header bytes (U14): PNG, WebP and JPEG, without decoding."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F, types as T

UNKNOWN = (-1, -1)


def header_size(content: bytes | None) -> tuple[int, int]:
    """Width and height; -1 where the bytes are no such image or end too early."""
    content = content or b""
    little = lambda at, n: int.from_bytes(content[at : at + n], "little")
    big = lambda at, n: int.from_bytes(content[at : at + n], "big")
    if content.startswith(b"\x89PNG\r\n\x1a\n") and len(content) >= 24:
        return big(16, 4), big(20, 4)
    if content[:4] == b"RIFF" and content[8:12] == b"WEBP" and len(content) >= 30:
        kind = content[12:16]
        if kind == b"VP8 ":
            return little(26, 2) & 0x3FFF, little(28, 2) & 0x3FFF
        if kind == b"VP8L":
            bits = little(21, 4)
            return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
        if kind == b"VP8X":
            return little(24, 3) + 1, little(27, 3) + 1
    if content[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(content) and content[at] == 0xFF:
            marker = content[at + 1]
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):  # a frame, not a table
                return big(at + 7, 2), big(at + 5, 2)
            # fill bytes and markers without a segment, then segments by their length
            at += 1 if marker == 0xFF else 2 if marker == 0x01 or 0xD0 <= marker <= 0xD8 else 2 + max(2, big(at + 2, 2))
    return UNKNOWN


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
def image_size(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([header_size(c) for c in content], columns=["width", "height"])
