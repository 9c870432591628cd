"""WARC derivatives, the pipeline and the registry."""

import base64
import gzip
import hashlib
import html
import json
import random
import time
import zlib

import pytest

from marlspike.llm import warc

PAGE = '<html><head><title>A &amp; B</title><meta name="description" content="about it"><style>p{}</style><script>var t="</p>";</script></head><body><nav><a href="/x">X</a></nav><!-- no --><p>One  <b>two</b></p><div>three&nbsp;four</div><a href=\'y.html\'>Y</a></body></html>'


def test_page_text():
    text = lambda page: warc.read_page(page).text
    assert text(PAGE) == "X\nOne two\nthree four\nY"
    assert text("a < b <!-- open") == "a < b" and text("<script>x") == "" and text("ab<a href='x'") == "ab" and text("") == ""


def _slow_parts(page):
    """Text, links and description by a walk over the characters."""
    low, shown, i = page.lower(), [], 0
    while i < len(page):
        if low.startswith("<!--", i):
            end = low.find("-->", i + 4)
            i, gone = (len(page) if end < 0 else end + 3), True
        else:
            name = next((n for n in ("script", "style") if low.startswith("<" + n, i) and not low[i + len(n) + 1 : i + len(n) + 2].isalnum()), None)
            gone = name is not None
            if gone:
                end = i + len(name) + 1
                while end < len(page) and not (low.startswith(f"</{name}", end) and low[end + len(name) + 2 :].lstrip().startswith(">")):
                    end += 1
                i = low.find(">", end) + 1 if end < len(page) else len(page)
        shown.append(" " if gone else page[i])
        i += not gone
    page = "".join(shown)
    tags, text, links, about, i = [], [], [], None, 0
    while i < len(page):
        after, then = page[i + 1 : i + 2], page[i + 2 : i + 3]
        starts = page[i] == "<" and (after == "!" or (after.isascii() and after.isalpha()) or (after in ("/", "?") and then.isascii() and then.isalpha()))
        if not starts:
            text.append(page[i])
            i += 1
            continue
        end = page.find(">", i)
        if end < 0:
            break
        tags.append(page[i : end + 1])
        text.append(tags[-1])
        i = end + 1
    out, skip = [], False
    for piece in text:
        low = piece.lower()
        if len(piece) > 1 and low.startswith("<title"):
            out, skip = [*out, " "], True
        elif len(piece) > 1 and low.startswith("</title"):
            skip = False
        elif skip:
            continue
        elif len(piece) > 1:
            name = low.strip("</>").split()[0] if low.strip("</>").split() else ""
            out.append("\n" if name.strip("/") in ("p", "br", "div") else "")
        else:
            out.append(piece)
    for tag in tags:
        body = tag[:-1]
        if tag[:3].lower() == "<a " and "href=" in tag.lower():
            value = body[body.lower().index("href=") + 5 :]
            value = value[1:].split(value[0])[0] if value[:1] in ("'", '"') and value[0] in value[1:] else value.split()[0] if value.split() and not value[:1].isspace() else None
            links += [html.unescape(value)] if value is not None else []
        if tag[:6].lower() == "<meta " and "name=description" in tag and "content='" in tag and about is None:
            about = html.unescape(tag.split("content='")[1].split("'")[0]) if tag.split("content='")[1].count("'") else None
    lines = (" ".join(x.split()) for x in html.unescape("".join(out)).split("\n"))
    return "\n".join(x for x in lines if x), links, about


def test_parts_of_random_pages():
    """Tags, comments and scripts opened and closed in any order."""
    bits = ["<a href='x&amp;1'>", "<a href=y>", "<a ", "</a>", ">", "<!--", "-->", "<script>", "</script>", "<style >", "</style >", "word", " ", "\n", "<p>", "</p >", "<br/>", "<b>", "&lt;", "<", "</", "<div id=1>", "é", "<meta name=description content='d'>", "<i", "<title>t</title>"]
    rng = random.Random(3)
    for _ in range(4000):
        page = "".join(rng.choices(bits, k=rng.randrange(1, 14)))
        got = warc.read_page(page)
        assert (got.text, got.links, got.description) == _slow_parts(page), page


def test_hostile_pages_take_linear_time():
    for page in ("<a " * 1_700_000, "<a " * 1_700_000 + ">", "<meta " * 800_000, "<!--" * 1_000_000, "<script" * 700_000, "<a href='" * 500_000, "<p " * 1_500_000):
        start = time.perf_counter()
        record = warc.response_record("http://x", page, "2024-01-01T00:00:00Z")
        warc.derive(record)
        assert time.perf_counter() - start < 20


def _response(body, *fields):
    block = "\r\n".join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", *fields]).encode() + b"\r\n\r\n" + body
    return warc.write_record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:r>"), ("WARC-Payload-Digest", warc.sha1(body))], block)


def test_codings_of_the_body():
    page = PAGE.encode()
    chunked = lambda b: b"".join(f"{len(b[i:i + 50]):x};q=1\r\n".encode() + b[i : i + 50] + b"\r\n" for i in range(0, len(b), 50)) + b"0\r\n\r\n"
    raw = zlib.compressobj(wbits=-15)
    deflated = raw.compress(page) + raw.flush()
    for record in (
        _response(gzip.compress(page), "Content-Encoding: gzip"), _response(zlib.compress(page), "Content-Encoding: deflate"), _response(deflated, "content-encoding: Deflate"),
        _response(chunked(page), "Transfer-Encoding: chunked"), _response(chunked(gzip.compress(page)), "Content-Encoding: x-gzip", "Transfer-Encoding: chunked"), _response(page, "Content-Encoding: identity"),
    ):
        got = warc.derive(record)
        assert got["text"] == "X\nOne two\nthree four\nY" and got["payload_ok"] and got["n_links"] == 2
    cut = warc.derive(_response(gzip.compress(page)[:-40], "Content-Encoding: gzip"))
    assert cut["payload_ok"] and "undecoded" not in json.loads(warc.parse_record(cut["metadata_record"])[1])
    for record, coding in ((_response(page, "Content-Encoding: br"), "br"), (_response(page, "Content-Encoding: gzip"), "gzip")):
        got = warc.derive(record)
        assert got["text"] == "" and got["payload_ok"] and json.loads(warc.parse_record(got["metadata_record"])[1])["undecoded"] == coding
    assert warc.derive(_response(b"", "Content-Encoding: gzip"))["text"] == ""


def test_derivatives_keep_ids_headers_and_digests(spark):
    pages = spark.createDataFrame([(1, "http://a/b c", PAGE, 9), (2, None, None, 9), (3, "http://x", "", 9), (1, "http://a/b c", PAGE, 9)], "page_id long, url string, html string, record int")
    got = warc.derivatives(warc.responses(pages)).collect()
    assert len(got) == 4
    for r in got:
        for kind in ("metadata", "conversion"):
            headers, block = warc.parse_record(r[f"{kind}_record"])
            h = dict(headers)
            assert h["WARC-Type"] == kind and h["WARC-Refers-To"] == r["response_id"] and h["WARC-Record-ID"] == r[f"{kind}_id"]
            assert h["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode() == r[f"{kind}_digest"]
            assert h.get("WARC-Target-URI") == r["target_uri"]
        assert r["payload_ok"]
    first = next(r for r in got if r["page_id"] == 1)
    assert first["title"] == "A & B" and first["n_links"] == 2 and first["target_uri"] == "http://a/b%20c"
    meta = json.loads(warc.parse_record(first["metadata_record"])[1])
    assert meta["links"] == ["/x", "y.html"] and meta["source"]["WARC-Payload-Digest"] == first["payload_digest"] and meta["description"] == "about it"
    second = next(r for r in got if r["page_id"] == 2)
    assert second["text"] == "" and second["target_uri"] is None


def test_archives(spark, tmp_path):
    records = [warc.response_record(f"http://x/{i}", PAGE, "2024-01-01T00:00:00Z") for i in range(3)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(warc.gzip_member, records)))
    (tmp_path / "b.warc").write_bytes(b"".join(records))
    read = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(bytes(r["record"]) for r in read) == sorted(records * 2)
    other = warc.write_record([("WARC-Type", "request"), ("WARC-Record-ID", "<urn:x>")], b"")
    df = spark.createDataFrame([(1, other), (2, None)], "page_id long, record binary")
    assert warc.derivatives(df).count() == 0
    empty = df.limit(0)
    assert warc.derivatives(empty).count() == 0
    assert warc.responses(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    with pytest.raises(ValueError):
        warc.parse_record(b"nothing")
    for broken in (b"nothing", records[0][:-30], b"WARC/1.0\r\nA: b\r\n\r\n", b"".join(records)[:-30]):
        with pytest.raises(ValueError):
            list(warc.split_archive(broken))
    bad = records[0].replace(b"sha1:", b"sha1:A", 1)
    assert not warc.derive(bad)["payload_ok"]


def test_archives_in_any_split():
    """Members that hold part of a record or several, padding between them, and records with no, much or blank content."""
    rng = random.Random(5)
    records = [warc.response_record(f"http://x/{i}", "\r\n" * rng.randrange(5) + "p" * rng.choice([0, 1, 1000, 3_000_000]), "2024-01-01T00:00:00Z") for i in range(12)]
    whole = b"".join(records)
    for _ in range(5):
        cuts = sorted(rng.sample(range(1, len(whole)), 9))
        members = [gzip.compress(whole[a:b]) for a, b in zip([0, *cuts], [*cuts, len(whole)])]
        assert list(warc.split_archive(bytes(rng.randrange(3)).join(members))) == records
    assert list(warc.split_archive(whole)) == records and list(warc.split_archive(b"")) == []
    big = warc.response_record("http://x", "word " * 20_000, "2024-01-01T00:00:00Z")
    start = time.perf_counter()
    assert sum(1 for _ in warc.split_archive(big * 2_000)) == 2_000 and sum(1 for _ in warc.split_archive(gzip.compress(big) * 2_000)) == 2_000
    assert time.perf_counter() - start < 30


def test_pipeline_and_queries(spark, small):
    import __spark_entry__ as entry
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    total = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == columns, name
        n = docs.count()
        assert 0 < n <= (2 * total if name == "mixing" else total)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert out.count() == n
    assert set(entry.oracle_sql()) <= set(entry.queries()) and sum(k.startswith("op") for k in entry.queries()) >= 10


def test_oracle_of_exact_dedup(spark, small):
    import duckdb

    from marlspike.llm import registry

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{small}/documents.parquet'")
    want = con.sql(f"select doc_id, keep_id, group_size, kept, text_sha256 from ({registry.ORACLE_SQL['op6_exact_dedup']})").fetchall()
    got = registry.QUERIES["op6_exact_dedup"](spark, small).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)
