"""WARC derivatives: metadata and plain-text conversion records of response records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
_CRLF = b"\r\n"
#: The name space of record ids that are made from names.
SPACE = uuid.NAMESPACE_URL
DERIVED = "derivative string, record_id string, refers_to string, target_uri string, date string, content_type string, block_digest string, payload_digest string, content_length long, record binary"
_HIDDEN = ("script", "style", "noscript")
_BLOCKS = frozenset("p div br li ul ol tr td th table h1 h2 h3 h4 h5 h6 article section header footer nav title head body html blockquote pre main aside".split())
_NAME = re.compile(r"/?([a-zA-Z][a-zA-Z0-9]*)\b")
_ATTR = re.compile(r"""(?is)(?<![a-z0-9:_-])([a-z][a-z0-9:_-]*+)\s*+=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_LINKS = frozenset(("a", "img", "link", "script", "iframe"))


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record's bytes; Content-Length is the block's."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return _CRLF.join(x.encode("utf-8", "surrogatepass") for x in lines) + _CRLF * 2 + block + _CRLF * 2


def _headers(head: bytes) -> list[tuple[str, str]]:
    first, *lines = head.split(_CRLF)
    if not first.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    headers: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (b" ", b"\t") and headers:
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip().decode('utf-8', 'replace')}")
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("a header without a colon")
        headers.append((name.decode("utf-8", "replace"), value.strip().decode("utf-8", "replace")))
    return headers


def parse(data: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Headers in order, and the block.  Folded lines are joined; a bad record raises ValueError."""
    head, sep, rest = data.partition(_CRLF * 2)
    if not sep:
        raise ValueError("no WARC record")
    headers = _headers(head)
    size = dict((k.lower(), v) for k, v in headers).get("content-length", "")
    if not size.isdigit() or len(rest) < int(size):
        raise ValueError("the block isn't whole")
    return headers, rest[: int(size)]


def records(data: bytes) -> Iterator[bytes]:
    """The records of a WARC file's bytes, plain or with gzip members."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        head = data.find(_CRLF * 2, at) + 4
        if head < 4:
            raise ValueError("no WARC record")
        size = dict((k.lower(), v) for k, v in _headers(data[at : head - 4])).get("content-length", "")
        if not size.isdigit() or len(data) < head + int(size):
            raise ValueError("the block isn't whole")
        upto = head + int(size) + 4
        yield data[at:upto]
        at = upto


def response(url: str, body: bytes, date: str, name: str, content_type: str = "text/html; charset=utf-8") -> bytes:
    """A response record; its id is made from ``name``."""
    payload = _CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: " + content_type.encode(), b"Content-Length: " + str(len(body)).encode()]) + _CRLF * 2 + body
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(SPACE, name)}>"), ("WARC-Date", date), ("WARC-Target-URI", url)]
    headers += [("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(payload)), ("Content-Type", "application/http; msgtype=response")]
    return record(headers, payload)


def _parts(page: str) -> Iterator[tuple[str, str, str]]:
    """(name, inside, text after it) of each tag in order, first ("", "", text before any).

    One pass from left to right: a comment and the content of a script, style or
    noscript are left out, and ``/`` stands before the name of an end tag.  What
    is not closed is text: the search for an end that isn't there is not repeated.
    """
    low, at, name, inside = page.lower(), 0, "", ""
    if len(low) != len(page):  # some letters have longer lower cases
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in page)
    text: list[str] = []
    unclosed: set[str] = set()

    def find(what: str, start: int) -> int:
        if what in unclosed:
            return -1
        got = low.find(what, start)
        if got < 0:
            unclosed.add(what)
        return got

    while True:
        begin = low.find("<", at)
        if begin < 0:
            text.append(page[at:])
            break
        text.append(page[at:begin])
        if low.startswith("<!--", begin) and (end := find("-->", begin + 4)) >= 0:
            at = end + 3
            continue
        if (end := find(">", begin)) < 0:
            text.append(page[begin:])
            break
        tag = _NAME.match(low, begin + 1, end)
        yield name, inside, "".join(text)
        name, inside, text, at = ("/" * (low[begin + 1] == "/") + tag[1] if tag else "!"), page[tag.end() : end] if tag else "", [], end + 1
        if name in _HIDDEN and (close := find(f"</{name}", at)) >= 0 and (end := find(">", close)) >= 0:
            yield name, inside, ""
            name, inside, at = f"/{name}", "", end + 1
    yield name, inside, "".join(text)


def plain_text(page: str | list) -> str:
    """Visible text of HTML or its parts: a line for each block element, runs of white space as one space."""
    out = []
    for name, _, text in _parts(page) if isinstance(page, str) else page:
        if name.lstrip("/") in _BLOCKS:
            out.append("\n")
        out.append(text)
    lines = (" ".join(x.split()) for x in html.unescape("".join(out)).split("\n"))
    return "\n".join(x for x in lines if x)


def _attributes(tag: str) -> dict[str, str]:
    return {m[0].lower(): html.unescape(m[1] or m[2] or m[3]) for m in _ATTR.findall(tag)}


def page_metadata(url: str, page: str | list) -> dict:
    """Title, metas and links (absolute, in order, each once) of HTML or its parts."""
    title: list[str] | None = None
    titled = False
    metas, links = [], {}
    for name, inside, text in _parts(page) if isinstance(page, str) else page:
        if name == "title" and not titled and title is None:
            title = [text]
        elif title is not None and not titled:
            if name == "/title":
                titled = True
            else:
                title.append(text)
        if name == "meta" and (own := _attributes(inside)):
            metas.append(own)
        if name in _LINKS:
            own = _attributes(inside)
            if target := own.get("href") or own.get("src"):
                try:
                    target = urljoin(url, target)
                except ValueError:  # not a URL: kept as it stands
                    pass
                links[(name, target)] = None
    return {"title": " ".join(html.unescape("".join(title)).split()) if titled else None, "metas": metas, "links": [{"tag": t, "url": u} for t, u in links]}


def derive(data: bytes | None) -> list[tuple]:
    """The derived records of one record, as rows of ``DERIVED``.

    A response of HTML or text gives ``metadata`` and ``conversion``; of another
    type, metadata alone.  Records of other types give nothing.  Null and broken
    records give one row ``error`` with the record unchanged, so none is lost.
    Both refer to the response's id, carry its target and date, and keep its
    payload digest; it is computed where the source has none.
    """
    try:
        headers, block = parse(data or b"")
        own = {k.lower(): v for k, v in headers}
        if own.get("warc-type") != "response":
            return []
        source, target, date = own["warc-record-id"], own.get("warc-target-uri", ""), own.get("warc-date", "")
        head, _, body = block.partition(_CRLF * 2)
        status, *lines = head.decode("utf-8", "replace").split("\r\n")
        http = [tuple(x.strip() for x in line.partition(":")[::2]) for line in lines if line]
    except (ValueError, KeyError):
        return [("error", None, None, None, None, None, None, None, len(data or b""), data)]
    kind = next((v for k, v in http if k.lower() == "content-type"), "")
    charset = re.search(r"(?i)charset=[\"']?([\w.:-]+)", kind)
    try:
        page = body.decode(charset[1] if charset else "utf-8", "replace")
    except (LookupError, ValueError):  # no such charset, or one that refuses the bytes
        page = body.decode("utf-8", "replace")
    payload = own.get("warc-payload-digest") or digest(body)
    is_html = kind.lower().startswith(("text/html", "application/xhtml")) or not kind
    is_text = is_html or kind.lower().startswith("text/")
    envelope = {"warc-headers": [list(x) for x in headers], "http-status": status, "http-headers": [list(x) for x in http], "payload-digest": payload, "payload-length": len(body)}
    if is_html:
        page = list(_parts(page))
        envelope["html"] = page_metadata(target, page)
    made = [("metadata", "application/json", json.dumps(envelope, ensure_ascii=False).encode("utf-8", "replace"))]
    if is_text:
        made.append(("conversion", "text/plain", (plain_text(page) if is_html else page).encode("utf-8", "replace")))
    out = []
    for derivative, content_type, text in made:
        name = f"<urn:uuid:{uuid.uuid5(SPACE, f'{derivative}:{source}')}>"
        fields = [("WARC-Type", derivative), ("WARC-Record-ID", name), ("WARC-Refers-To", source), ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", payload), ("WARC-Block-Digest", digest(text)), ("Content-Type", content_type)]
        out.append((derivative, name, source, target, date, content_type, digest(text), payload, len(text), record(fields, text)))
    return out


def derivatives(df: DataFrame, record_col: str = "record", keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each derived record of ``df``'s records, after the columns ``keep``.

    Map side only; repeated records are derived each, an empty table gives an
    empty table.  A kept column that has the name of a derived one is left out:
    the derived record's own value stands.
    """
    names = [f.split()[0] for f in DERIVED.split(", ")]
    kept = [c for c in keep if c not in names]
    fields = df.select(*kept).schema
    held = [f"k{i}" for i in range(len(kept))]  # whatever they are called, they don't meet the record's name

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(at, *row) for at, data in enumerate(frame["__record"]) for row in derive(data)]
            made = pd.DataFrame([r[1:] for r in rows], columns=names)
            own = frame[held].iloc[[r[0] for r in rows]].reset_index(drop=True)
            yield pd.concat([own, made], axis=1)

    schema = ", ".join([*(f"{h} {f.dataType.simpleString()}" for h, f in zip(held, fields)), DERIVED])
    out = df.select(*(F.col(c).alias(h) for c, h in zip(kept, held)), F.col(record_col).alias("__record")).mapInPandas(run, schema)
    return out.select(*(F.col(h).alias(c) for h, c in zip(held, kept)), *names)


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> Column:
    """The response record of a page (page_id, url, html); null url and html are empty."""

    @F.pandas_udf("binary")
    def make(ids: pd.Series, urls: pd.Series, bodies: pd.Series) -> pd.Series:
        return pd.Series([response(u or "", (b or "").encode("utf-8", "surrogatepass"), date, f"page:{i}") for i, u, b in zip(ids, urls, bodies)], dtype=object)

    return make(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("url"), F.col("html"))


def write_warc(rows: DataFrame, path: str) -> None:
    """One ``.warc.gz`` member a record: each record's gzip bytes, a Parquet file set of members a task.

    Members are whole gzip files, so the concatenation of any of them is a WARC file.
    """

    @F.pandas_udf("binary")
    def member(data: pd.Series) -> pd.Series:
        return pd.Series([gzip.compress(x, mtime=0) for x in data], dtype=object)

    rows.select("record_id", "derivative", member("record").alias("member")).write.mode("overwrite").parquet(path)


def op6_warc_derivatives(spark, sf_dir: str) -> DataFrame:
    """The metadata and conversion records of every page's response record."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return derivatives(pages.withColumn("record", responses(pages)), keep=("page_id",))
