"""Content format of a text or binary value."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Leading bytes (hex) of the binary formats.
MAGIC = {
    "PDF": "255044462D",
    "PNG": "89504E470D0A1A0A",
    "JPEG": "FFD8FF",
    "GZIP": "1F8B",
    "PARQUET": "50415231",
    "ZIP": "504B0304",
}
# A member name that tells an office document from a plain archive.
ZIP_MEMBER = {"DOCX": "word/", "XLSX": "xl/"}

FORMATS = ("JSON", "XML", "CSV", "PDF", "DOCX", "XLSX", "PNG", "JPEG", "ZIP", "GZIP", "PARQUET")


def _as_bytes(col: Column, binary: bool) -> Column:
    # A cast keeps the bytes as they are, also where they are not valid text.
    return col if binary else col.cast("binary")


def is_format(col: Column, content_format: str, binary: bool = False) -> Column:
    """Whether a value has the given format.

    Text formats are tested on the text, binary ones on leading bytes. An office
    document is an archive with a typical member name, and no longer counts as ZIP.
    """
    fmt = content_format.upper()
    if fmt not in FORMATS:
        raise ValueError(f"unknown content format {content_format!r}")
    if fmt in MAGIC or fmt in ZIP_MEMBER:
        data = _as_bytes(col, binary)
        head = F.hex(F.substring(data, 1, 8))
        if fmt not in ZIP_MEMBER and fmt != "ZIP":
            return head.startswith(MAGIC[fmt])
        archive = head.startswith(MAGIC["ZIP"])
        members = {k: F.contains(data, F.lit(v).cast("binary")) for k, v in ZIP_MEMBER.items()}
        if fmt == "ZIP":
            return archive & ~(members["DOCX"] | members["XLSX"])
        return archive & members[fmt]
    body = F.trim(F.try_validate_utf8(col.cast("string")))
    if fmt == "JSON":
        parsed = F.call_function("try_parse_json", body)
        return F.substring(body, 1, 1).isin("{", "[") & parsed.isNotNull()
    if fmt == "XML":
        return body.rlike(r"^<[?!A-Za-z]") & body.endswith(">")
    # CSV: two or more lines, and the first two have the same number (one or more) of commas.
    first = F.split_part(body, F.lit("\n"), F.lit(1))
    second = F.split_part(body, F.lit("\n"), F.lit(2))
    commas = F.char_length(first) - F.char_length(F.replace(first, F.lit(","), F.lit("")))
    commas_2 = F.char_length(second) - F.char_length(F.replace(second, F.lit(","), F.lit("")))
    plain = ~F.substring(body, 1, 1).isin("{", "[", "<")
    return plain & (commas >= 1) & (commas == commas_2)
