"""WARC derivatives: links to their responses, digests, text by another parser, and valid files."""

import gzip
import hashlib
import io
import json
from html.parser import HTMLParser

from pyspark.sql import functions as F
from tables import TEST_DIR

from lintel.llm import warc


class Visible(HTMLParser):
    """The visible words of a page by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.links, self.hidden, self.title = [], 0, 0, ""
        self.in_title = False

    def handle_starttag(self, tag, attrs):
        self.links += tag == "a" and "href" in dict(attrs)
        self.hidden += tag in ("script", "style")
        self.in_title = tag == "title"

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        self.in_title = False

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif not self.hidden:
            self.words.append(data)


def test_every_page(spark):
    pages = spark.read.parquet(f"{TEST_DIR}/pages.parquet")
    given = warc.responses(pages)
    rows = warc.derivatives(given, ["page_id"]).collect()
    sources = {r.record_id: r for r in given.collect()}
    html = {r.page_id: (r.url, r.html) for r in pages.collect()}
    assert len(rows) == 2 * len(html) and len({r.record_id for r in rows}) == len(rows)
    for r in rows:
        source = sources[r.refers_to]
        assert (r.page_id, r.target_uri, r.warc_date, r.source_headers, r.source_payload_digest) == (
            source.page_id, html[r.page_id][0], source.warc_date, source.http_headers, source.payload_digest)
        raw = r.content.encode()
        assert r.content_length == len(raw) and r.block_digest == "sha256:" + hashlib.sha256(raw).hexdigest()
        assert source.payload_digest == "sha256:" + hashlib.sha256(html[r.page_id][1].encode()).hexdigest()
        seen = Visible()
        seen.feed(html[r.page_id][1])
        if r.warc_type == "metadata":
            told = json.loads(r.content)["Envelope"]
            assert told["WARC-Header-Metadata"]["WARC-Record-ID"] == r.refers_to
            page = told["Payload-Metadata"]["HTTP-Response-Metadata"]["HTML-Metadata"]
            assert len(page["Links"]) == seen.links and page["Head"]["Title"] == " ".join(seen.title.split())
            assert ["Content-Type", "text/html; charset=utf-8"] in told["Payload-Metadata"]["HTTP-Response-Metadata"]["Headers"]
        elif "&a" not in html[r.page_id][1][-8:]:
            assert r.content.replace("\n", "").replace(" ", "") == "".join("".join(seen.words).split())


def test_page_reading():
    text, title, links, metas, lang = warc.read_page(
        '<html lang=de><title>A &amp; B</title><meta name="x" content="y"><script src=/s.js>if (a<b) "<p>"</script>'
        "<p>one<b>two</b> &lt;three&gt;<br>four<img src='i.png'><a href=\"../up\">five</a><!-- six", "http://h.example/a/b/c",
    )
    assert text == "onetwo <three>\nfourfive" and title == "A & B" and metas == {"x": "y"} and lang == "de"
    assert [x["url"] for x in links] == ["http://h.example/s.js", "http://h.example/a/b/i.png", "http://h.example/a/up"]
    for page in ("", "<", "<!--", "<p", "<script>", "no tags", "<!--" * 20000, "<a href=" * 20000, "<script" * 20000):
        warc.read_page(page, "")


def test_awkward_rows(spark):
    pages = spark.createDataFrame(
        [(1, None, None), (None, "http://a", "<p>x"), (2, "http://[bad", "<a href='http://[x'>y</a>"), (3, "u", ""), (3, "u", ""), (4, "u", "w " * 300000)],
        "page_id long, url string, html string",
    ).withColumn("content", F.lit("clash")).withColumn("record_id", F.lit("clash"))
    rows = warc.derivatives(warc.responses(pages), ["page_id"]).collect()
    assert len(rows) == 12 and all(r.content is not None and r.refers_to for r in rows)
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0


def test_segments_are_valid_files(spark):
    pages = spark.read.parquet(f"{TEST_DIR}/pages.parquet").limit(20)
    records = warc.derivatives(warc.responses(pages))
    rows = warc.segments(records, 20000).collect()
    assert sum(r.n_records for r in rows) == 40 and len(rows) > 1
    found = {}
    for row in rows:
        stream = io.BytesIO(gzip.decompress(row.warc))
        while line := stream.readline():
            assert line == b"WARC/1.1\r\n"
            fields = {}
            while (line := stream.readline()) != b"\r\n":
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                fields[name] = value
            body = stream.read(int(fields["Content-Length"]))
            assert stream.read(4) == b"\r\n\r\n" and fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(body).hexdigest()
            found[fields["WARC-Record-ID"]] = (fields["WARC-Refers-To"], body.decode())
    assert found == {r.record_id: (r.refers_to, r.content) for r in records.collect()}
