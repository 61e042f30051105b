"""Type and dimensions of images from their first bytes."""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.sources.webarchive import arrow_batch, arrow_schema


def detect_mime(data: bytes) -> str:
    """From magic bytes; '' if unknown."""
    for magic, mime in ((b"\x89PNG\r\n\x1a\n", "image/png"), (b"GIF87a", "image/gif"), (b"GIF89a", "image/gif"), (b"\xff\xd8\xff", "image/jpeg"), (b"BM", "image/bmp"), (b"II*\0", "image/tiff"), (b"MM\0*", "image/tiff"), (b"\0\0\1\0", "image/x-icon")):
        if data.startswith(magic):
            return mime
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        return "image/webp"
    return "image/svg+xml" if re.match(rb"\s*(<\?xml[^>]*>\s*)?(<!--.*?-->\s*)*(<!DOCTYPE svg[^>]*>\s*)?<svg[\s>]", data[:2000], re.S) else ""


def dimensions(data: bytes, mime: str) -> tuple[int, int] | None:
    """Width and height from the header; null for webp and icons, which have no reader, and for broken headers."""
    try:
        if mime == "image/png":
            return struct.unpack(">II", data[16:24])
        if mime == "image/gif":
            return struct.unpack("<HH", data[6:10])
        if mime == "image/bmp":
            w, h = struct.unpack("<ii", data[18:26])
            return w, abs(h)
        if mime == "image/jpeg":
            at = 2
            while data[at] == 0xFF:
                kind, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
                if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                    return w, h
                at += 2 + size
        if mime == "image/tiff":
            e = "<" if data[:2] == b"II" else ">"
            (start,) = struct.unpack(e + "I", data[4:8])
            (n,) = struct.unpack(e + "H", data[start : start + 2])
            tags = {}
            for i in range(n):
                entry = data[start + 2 + 12 * i : start + 14 + 12 * i]
                tag, kind = struct.unpack(e + "HH", entry[:4])
                tags[tag] = struct.unpack(e + ("H" if kind == 3 else "I"), entry[8 : 10 if kind == 3 else 12])[0]
            return tags[256], tags[257]
        if mime == "image/svg+xml":
            head = re.search(rb"<svg[^>]*>", data, re.S).group().decode("utf-8", "replace")
            sides = [re.search(rf"\b{s}\s*=\s*[\"']([0-9.]+)", head) for s in ("width", "height")]
            if all(sides):
                return tuple(int(float(m.group(1))) for m in sides)
    except (struct.error, IndexError, KeyError, AttributeError):
        pass
    return None


def inline_bytes(data_url: str) -> tuple[str, bytes]:
    """Type and bytes of a data: URL."""
    head, _, body = data_url.partition(",")
    parts = head[5:].split(";")
    if any("base64" in p for p in parts[1:]):
        try:
            return parts[0], base64.b64decode(unquote_to_bytes(body), validate=False)
        except ValueError:
            return parts[0], b""
    return parts[0], unquote_to_bytes(body)


def probe_one(data: bytes | None, reported: str | None) -> tuple[str, int | None, int | None]:
    """Detected type, or the reported one, and sides."""
    data = data or b""
    found = detect_mime(data) or (reported or "")
    return found, *(dimensions(data, found) or (dimensions(data, reported) if reported else None) or (None, None))


def probed(captures: DataFrame, payload: str = "payload", mime: str = "mime", inline: str | None = None) -> DataFrame:
    """captures with digest (of the original bytes), size, mime_detected, width and height; undecodable ones have null sides.

    Where the column `inline` has a data: URL, type and bytes come from it; the column goes.
    """

    schema = "mime_detected string, width int, height int, mime string, payload binary"

    @F.arrow_udf(schema)
    def probe(data: pa.Array, reported: pa.Array, urls: pa.Array) -> pa.Array:
        rows = []
        for d, r, u in zip(data, reported, urls):
            mime, opened = inline_bytes(u.as_py()) if u.is_valid else (r.as_py(), None)
            rows.append((*probe_one(d.as_py() if opened is None else opened, mime), mime, opened))
        return arrow_batch(rows, arrow_schema(schema)).to_struct_array()

    # not deterministic to the planner, which else runs it again for every filter on what it found
    out = captures.withColumn("p", probe.asNondeterministic()(F.col(payload), F.col(mime), F.col(inline) if inline else F.lit(None).cast("string")))
    if inline:
        out = out.withColumns({mime: F.col("p.mime"), payload: F.coalesce("p.payload", payload)}).drop(inline)
    return out.withColumns({"digest": F.sha2(payload, 256), "size": F.octet_length(payload), "mime_detected": F.col("p.mime_detected"), "width": F.col("p.width"), "height": F.col("p.height")}).drop("p")
