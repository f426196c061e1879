"""Readers and writers, round trips."""

import zipfile

from pyspark.sql import functions as F

from inkwright.sources import docx, front_matter, sinks
from inkwright.streaming import watch

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
A = "http://schemas.openxmlformats.org/drawingml/2006/main"
R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write_docx(path):
    doc = f'<w:document xmlns:w="{W}" xmlns:a="{A}" xmlns:r="{R}"><w:body><w:p><w:r><w:t>Hola </w:t><w:t>mundo</w:t></w:r></w:p><w:p><w:r><w:t> 12 </w:t></w:r></w:p><w:p><w:r><a:blip r:embed="r1"/><w:p><w:r><w:t>caja</w:t></w:r></w:p></w:r></w:p></w:body></w:document>'
    rels = '<Relationships><Relationship Id="r1" Type="x/image" Target="media/i.png"/></Relationships>'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", doc)
        z.writestr("word/_rels/document.xml.rels", rels)
        z.writestr("word/media/i.png", b"png")


def test_docx_blocks(spark, tmp_path):
    write_docx(tmp_path / "Vol. 3 - Serie 7 (incompleta).docx")
    rows = docx.read_blocks(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r.pos, r.text, r.images, r.pagenum) for r in rows] == [(0, "Hola mundo", [], None), (1, " 12 ", [], 12), (2, "caja", ["word/media/i.png"], None), (3, "caja", [], None)]
    assert len(rows[2].hashes[0]) == 10
    meta = spark.createDataFrame([(rows[0].issue_id.replace("%20", " "),), ("x",)], "p string").select(front_matter.file_meta(F.col("p")).alias("m")).select("m.*")
    assert sorted(map(tuple, meta.collect())) == [(0, 0, False), (3, 7, True)]


def test_docx_media_and_packed_files(spark):
    rows = spark.createDataFrame([("a", [("uno & <dos>", True), ("", False), ("7", True)]), ("b", [])], "path string, turns array<struct<text:string,image:boolean>>")
    files = rows.select("path", docx.packed(F.col("turns")).alias("content"))
    assert [(r.issue_id, r.pos, r.text, r.pagenum, len(r.images)) for r in docx.blocks(files).orderBy("pos").collect()] == [("a", 0, "uno & <dos>", None, 1), ("a", 1, "", None, 0), ("a", 2, "7", 7, 1)]
    assert sorted((r.issue_id, r.name, bytes(r.content)) for r in docx.media(files).collect()) == [("a", "word/media/image0.png", b"image 0"), ("a", "word/media/image2.png", b"image 2")]


def article(spark):
    row = [('Un "tren"', "un-tren", 6, 2, "2012-12", "Ana", ["Rail"], "editorial", 3, None, ["word/media/a.png"], "uno dos", ["date-missing"], ["Uno.", "Dos."])]
    df = spark.createDataFrame(row, "title string, slug string, series int, volume int, issue_date string, author string, themes array<string>, feature_type string, page_start int, page_end int, images array<string>, summary string, review array<string>, paragraphs array<string>")
    return df.select(sinks.article_markdown({c: F.col(c) for c in df.columns}).alias("value"), F.lit(6).alias("series"))


def test_article_round_trip(spark, tmp_path):
    written = article(spark)
    sinks.write_documents(written, str(tmp_path / "out"), ["series"])
    back = written.select(F.lit("serie-6/01-un-tren.md").alias("path"), F.col("value").alias("text"))
    row = front_matter.index_rows(back).first()
    assert (row.series, row.volume, row.order, row.themes, row.page_start, row.page_end, row.image_count, row.review, row.file) == ("6", "2", "01", "Rail", "3", "null", "1", "date-missing", "serie-6/01-un-tren.md")
    typed = front_matter.articles(back).first()
    assert (typed.id, typed.page_end, typed.author, typed.is_featured, typed.lang_available, typed.review) == ("serie-6/01-un-tren", None, "Ana", False, ["es"], ["date-missing"])
    assert typed.body.startswith('# Un "tren"\n') and "  - a.png\n" in typed.body
    assert front_matter.typed_index(front_matter.index_rows(back)).first().page_end is None
    sinks.write_index_csv(front_matter.index_rows(back), str(tmp_path / "index"))
    assert spark.read.option("header", True).csv(str(tmp_path / "index")).first().title_es == row.title_es


def test_header_corner_cases(spark):
    texts = ["x\n---\na: b\n---", "---\na: b", '---\nk: "a # b"\nk: last\nL: no\n---\nz', "---\nt: [ ]\n---"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(front_matter.header(F.col("t")).alias("h"))
    assert [r.h for r in df.collect()] == [{}, {}, {"k": "last"}, {"t": "[ ]"}]
    cover = spark.createDataFrame([('title_es: "Uno"\nauthor: a"b\n![x](/img/c.webp)',)], "t string").select(front_matter.cover(F.col("t")).alias("c")).select("c.*").first()
    assert tuple(cover) == ("Uno", "", "", "/img/c.webp")


def test_watched_folder_is_indexed_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "01-a.md").write_text("---\nseries: 6\n---\n")
    for name in ("02-b.md", None, None):
        q = watch.keep_index(watch.watch_articles(spark, str(folder)), str(tmp_path / "out"), str(tmp_path / "state"))
        q.awaitTermination()
        if name:
            (folder / name).write_text("---\nseries: 7\n---\n")
    assert front_matter.read_markdown(spark, str(folder)).count() == 2
    assert sorted(r.series for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["6", "7"]
