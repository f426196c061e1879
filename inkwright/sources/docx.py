"""Word files as blocks: one row for each paragraph, in document order."""

from __future__ import annotations

import hashlib
import io
import posixpath
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
DRAWING = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
EMBED = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}embed"
BLOCKS = "issue_id string, pos int, text string, images array<string>, pagenum int, hashes array<string>"


def blocks_of(raw: bytes) -> list[tuple]:
    """(pos, text, images, pagenum, hashes); a paragraph in a text box is part of its outer one and a block of its own."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = set(z.namelist())
        media = {}
        if "word/_rels/document.xml.rels" in names:
            for r in ElementTree.fromstring(z.read("word/_rels/document.xml.rels")):
                if "image" in r.get("Type", ""):
                    media[r.get("Id")] = posixpath.normpath(posixpath.join("word", r.get("Target", "")))
        digests = {m: hashlib.md5(z.read(m)).hexdigest()[:10] if m in names else None for m in set(media.values())}
        out = []
        for pos, p in enumerate(ElementTree.fromstring(z.read("word/document.xml")).iter(f"{WORD}p")):
            text = "".join(t.text or "" for t in p.iter(f"{WORD}t"))
            images = [media[b.get(EMBED)] for b in p.iter(f"{DRAWING}blip") if b.get(EMBED) in media]
            bare = text.strip()
            out.append((pos, text, images, int(bare) if bare.isdecimal() and len(bare) <= 3 else None, [digests[m] for m in images]))
    return out


def blocks(files: DataFrame) -> DataFrame:
    """Blocks of files (path, content); issue_id is the path. A file is one task's row, so its size bounds the memory."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, raw in zip(batch["path"], batch["content"], strict=True):
                found = pd.DataFrame(blocks_of(raw), columns=["pos", "text", "images", "pagenum", "hashes"]).astype({"pagenum": "Int32"})
                found.insert(0, "issue_id", path)
                yield found

    return files.select("path", "content").mapInPandas(parse, BLOCKS)


def read_blocks(spark: SparkSession, glob: str) -> DataFrame:
    """Blocks of all files of a glob."""
    return blocks(spark.read.format("binaryFile").load(glob))


def media(files: DataFrame) -> DataFrame:
    """issue_id, name, content of the media that files (path, content) hold."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, raw in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(raw)) as z:
                    for name in z.namelist():
                        if name.startswith("word/media/"):
                            yield pd.DataFrame({"issue_id": [path], "name": [name], "content": [z.read(name)]})

    return files.select("path", "content").mapInPandas(unpack, "issue_id string, name string, content binary")


def packed(paragraphs: Column) -> Column:
    """A Word file of paragraphs, an array of struct(text, image); those with an image show one of their own."""

    @F.pandas_udf("binary")
    def pack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            yield pd.Series([_file([(p["text"] or "", p["image"]) for p in own]) for own in column])

    return pack(paragraphs)


def _file(paragraphs: list[tuple[str, bool]]) -> bytes:
    body, links, raw = [], [], io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        for k, (line, image) in enumerate(paragraphs):
            picture = ""
            if image:
                z.writestr(f"word/media/image{k}.png", f"image {k}")
                links.append(f'<Relationship Id="r{k}" Type="x/image" Target="media/image{k}.png"/>')
                picture = f'<w:r><a:blip r:embed="r{k}"/></w:r>'
            body.append(f'<w:p><w:r><w:t xml:space="preserve">{escape(line)}</w:t></w:r>{picture}</w:p>')
        names = f'xmlns:w="{WORD[1:-1]}" xmlns:a="{DRAWING[1:-1]}" xmlns:r="{EMBED[1:].split("}")[0]}"'
        z.writestr("word/document.xml", f"<w:document {names}><w:body>{''.join(body)}</w:body></w:document>")
        z.writestr("word/_rels/document.xml.rels", f"<Relationships>{''.join(links)}</Relationships>")
    return raw.getvalue()
