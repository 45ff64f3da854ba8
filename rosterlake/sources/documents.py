"""Documents as a table of (path, content): text routing by file extension.

PDF text and OCR come from outside as columns; plain text and Word files are read here. Python gets the files by rows: an
Arrow batch would hold thousands of whole files.
"""

from __future__ import annotations

import io
import sys
import xml.etree.ElementTree as ET
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_space
from ..session import ship_with_tasks

# --- fixed values -------------------------------------------------------------------------------
KINDS = {"pdf": "pdf", "docx": "docx", "doc": "docx", "txt": "txt"}
MIN_TEXT = 50
WORD_SPACE = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
# --------------------------------------------------------------------------------------------------
#: Bytes of a file that is read, and bytes that a Word file may unpack to.
MAX_BYTES, MAX_TEXT = 256 << 20, 1 << 30
#: Partition column that holds the names of written files.
NAME = "_name"


def read_files(spark: SparkSession, path: str, glob: str = "*", max_bytes: int = MAX_BYTES) -> DataFrame:
    """(path, content) of every file; a file above ``max_bytes`` is listed without its content and not opened.

    A folder of :func:`write_files` gives the names that were written.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    name = F.col("path") if NAME not in files.columns else F.concat(F.lit(f"{path}/"), F.col(NAME))
    small = files.where(F.col("length") <= max_bytes).select(name.alias("path"), "content")
    return small.unionAll(files.where(F.col("length") > max_bytes).select(name.alias("path"), F.lit(None).cast("binary")))


def write_files(df: DataFrame, folder: str, name: str = "name", content: str = "content") -> None:
    """One file per row, its bytes followed by a line break, in a folder named after the row.

    Spark writes no binary files, but its text writer passes bytes through unchanged.
    """
    (df.select(F.col(content).cast("string").alias("value"), F.col(name).alias(NAME))
     .write.mode("overwrite").partitionBy(NAME).text(folder))


def word_file(paragraphs: Column) -> Column:
    """A minimal Word file of an array of paragraphs, as bytes."""
    return F.udf(_word_bytes, "binary", useArrow=False)(paragraphs)


def _word_bytes(paragraphs: list[str] | None) -> bytes:
    lines = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(p)}</w:t></w:r></w:p>' for p in paragraphs)
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as parts:
        parts.writestr("word/document.xml", f'<w:document xmlns:w="{WORD_SPACE[1:-1]}"><w:body>{lines}</w:body></w:document>')
    return held.getvalue()


def file_kind(path: Column) -> Column:
    """``pdf``, ``docx`` or ``txt`` by the extension; null if unsupported."""
    extension = F.regexp_extract(F.lower(path), r"\.([a-z]+)$", 1)
    table = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    return F.try_element_at(table, extension)


def _paragraphs(content: bytes, most: int = MAX_TEXT) -> str:
    """Paragraph texts of a Word file joined by line breaks; '' if it cannot be read or unpacks to more than ``most`` bytes.

    Paragraphs directly below the body count. The file is unpacked as a stream, and a finished paragraph is freed.
    """
    marks = {f"{WORD_SPACE}tab": "\t", f"{WORD_SPACE}br": "\n", f"{WORD_SPACE}cr": "\n"}
    lines, open_tags = [], []
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as parts, parts.open("word/document.xml") as stream:
            for event, node in ET.iterparse(_Bounded(stream, most), ("start", "end")):
                if event == "start":
                    open_tags.append(node)
                    continue
                open_tags.pop()
                inside = [n.tag for n in open_tags]
                if node.tag == f"{WORD_SPACE}p" and inside[1:] == [f"{WORD_SPACE}body"]:
                    lines.append("".join(n.text or "" if n.tag == f"{WORD_SPACE}t" else marks.get(n.tag, "") for n in node.iter()))
                if inside[1:] == [f"{WORD_SPACE}body"]:
                    open_tags[-1].remove(node)
    except Exception:  # any unreadable file counts as empty
        return ""
    return "\n".join(lines)


class _Bounded:
    """A stream that fails after so many bytes: a small file can unpack to a huge one."""

    def __init__(self, stream, most: int) -> None:
        self.stream, self.left = stream, most

    def read(self, size: int = -1) -> bytes:
        data = self.stream.read(min(size, 1 << 16) if size > 0 else 1 << 16)
        self.left -= len(data)
        if self.left < 0:
            raise ValueError("unpacks to too many bytes")
        return data


def _read(kind: Column, content: Column) -> Column:
    """Text of Word files, and of plain text with invalid bytes, which are dropped."""
    def read(kind: str, content: bytes | None) -> str | None:
        if content is None:
            return None
        return _paragraphs(content) if kind == "docx" else bytes(content).decode("utf-8", "ignore")

    return F.udf(read, "string", useArrow=False)(kind, content)


def parse_documents(files: DataFrame, pdf_text: str | None = None) -> DataFrame:
    """(path, kind, text, reason): one pass over the files; ``reason`` tells why there is no text.

    ``pdf_text`` names a column with the text layer of PDF files, if one was extracted. Valid UTF-8
    is taken as it is; only Word files and damaged text go through Python.
    """
    kind, content = F.col("kind"), F.col("content")
    as_text = content.cast("string")
    native = (kind == "txt") & F.is_valid_utf8(as_text)
    by_python = kind.isin("docx", "txt") & ~native
    layer = F.coalesce(F.col(pdf_text), F.lit("")) if pdf_text else F.lit("")
    text = (F.when(native, as_text).when(kind == "pdf", layer)
            .when(by_python, _read(kind, F.when(by_python, content))))
    return files.withColumn("kind", file_kind(F.col("path"))).select(
        "path", "kind", text.alias("text"),
        F.when(kind.isNull(), "unsupported file type").when(content.isNull(), "file is too large").alias("reason"))


def needs_ocr(text: Column, force: Column | bool = False) -> Column:
    force = F.lit(force) if isinstance(force, bool) else force
    return force | (F.char_length(strip_space(F.coalesce(text, F.lit("")))) < MIN_TEXT)


def choose_text(text: Column, ocr_text: Column, force: Column | bool = False) -> Column:
    """OCR text where OCR was due and found something, else the original."""
    found = F.coalesce(strip_space(ocr_text) != "", F.lit(False))
    return F.when(needs_ocr(text, force) & found, ocr_text).otherwise(F.coalesce(text, F.lit("")))


ship_with_tasks(sys.modules[__name__])
