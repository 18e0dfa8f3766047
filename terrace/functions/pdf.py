"""Text of the pages of PDF files, some at a time.

Read are: page trees, contents in one or several streams, plain or deflated, objects in object streams, text shown by
Tj, TJ, ' and ", strings in brackets or hexadecimal, in Latin-1 or by a font's ToUnicode map. Lines break where the text position is
moved to another line. Not read, with a reason instead of pages: encrypted files, other compressions, scanned pages, files
without a page. A damaged table of contents doesn't matter, as objects are found by themselves.
"""

from __future__ import annotations

import functools
import re
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

RESULT = "pages array<string>, reason string"
#: Most bytes that one stream may inflate to.
INFLATED = 256 << 20

OBJECT = re.compile(rb"(?:^|(?<=\s))(\d+)\s+\d+\s+obj\b")
REF = re.compile(rb"(\d+)\s+\d+\s+R\b")
LENGTH = re.compile(rb"/Length\s+(\d+)(?!\s+\d+\s+R)")
TOKEN = re.compile(rb"\(|<[0-9A-Fa-f\s]*+>|/[^\s/<>\[\]()%]++|[\[\]]|[-+.\d]++|[A-Za-z'\"*]++|%[^\r\n]*+")
BRACKET = re.compile(rb"\\.|[()]", re.S)
ESCAPE = re.compile(rb"\\([0-7]{1,3}|\r\n|.)", re.S)
ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f", b"\n": b"", b"\r": b"", b"\r\n": b""}


class Unread(Exception):
    """Why a file has no pages."""


def _inflate(data: bytes) -> bytes:
    out = zlib.decompressobj()
    try:
        text = out.decompress(data, INFLATED)
    except zlib.error as e:
        raise Unread("a stream is broken") from e
    if out.unconsumed_tail:
        raise Unread("a stream is too long")
    return text


def _stream(body: bytes) -> bytes | None:
    """The content of an object's stream."""
    at = body.find(b"stream")
    if at < 0:
        return None
    head = body[:at]
    begin = at + 6 + (2 if body[at + 6 : at + 8] == b"\r\n" else 1)
    known = LENGTH.search(head)
    end = begin + int(known[1]) if known else body.rfind(b"endstream")
    data = body[begin:end]
    kinds = re.findall(rb"/(\w+Decode)\b", head)
    if kinds == [b"FlateDecode"]:
        return _inflate(data)
    if kinds:
        raise Unread("unknown compression " + kinds[0].decode("latin-1"))
    return data


def _objects(data: bytes) -> dict[int, bytes]:
    found = list(OBJECT.finditer(data))
    if not found:
        return {}
    out = {int(m[1]): data[m.end() : n] for m, n in zip(found, [*(m.start() for m in found[1:]), len(data)], strict=True)}
    for body in list(out.values()):
        if re.search(rb"/Type\s*/ObjStm\b", body[:2000]):
            inner, first = _stream(body), re.search(rb"/First\s+(\d+)", body)
            if inner and first:
                numbers = [int(x) for x in inner[: int(first[1])].split()]
                places = [int(first[1]) + x for x in numbers[1::2]]
                for n, x, y in zip(numbers[::2], places, [*places[1:], len(inner)], strict=False):
                    out.setdefault(n, inner[x:y])
    return out


def _listed(body: bytes, key: bytes) -> list[int]:
    """The objects that an entry names, alone or in an array."""
    m = re.search(rb"/" + key + rb"\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", body)
    return [int(x) for x in REF.findall(m[1])] if m else []


def _pages(objects: dict[int, bytes]) -> list[tuple[bytes, list[bytes]]]:
    """Each page with what is above it in the page tree, in order."""
    roots = [n for body in objects.values() if re.search(rb"/Type\s*/Catalog\b", body) for n in _listed(body, b"Pages")]
    out, todo, seen = [], [(n, []) for n in reversed(roots)], set()
    while todo:
        n, above = todo.pop()
        body = objects.get(n, b"")
        if n in seen:
            continue
        seen.add(n)
        if re.search(rb"/Type\s*/Pages\b", body):
            todo += [(k, [*above, body]) for k in reversed(_listed(body, b"Kids"))]
        elif re.search(rb"/Type\s*/Page\b", body):
            out.append((body, above))
    return out


@functools.lru_cache(64)  # files of one maker have the same
def _unicode(cmap: bytes) -> tuple[dict[int, str], int]:
    """What a font's codes mean, and how many bytes a code has."""
    text = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
    width = max((len(x) // 2 for x in re.findall(rb"begincodespacerange\s*<([0-9A-Fa-f]+)>", cmap)), default=1)
    out: dict[int, str] = {}
    for part in re.findall(rb"beginbfchar(.*?)endbfchar", cmap, re.S):
        for code, means in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", part):
            out[int(code, 16)] = text(means)
    for part in re.findall(rb"beginbfrange(.*?)endbfrange", cmap, re.S):
        for low, high, means in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]{4})>", part):
            for i in range(min(int(high, 16) - int(low, 16) + 1, 1 << 16)):
                out[int(low, 16) + i] = chr(int(means, 16) + i)
    return out, width


def _fonts(page: bytes, above: list[bytes], objects: dict[int, bytes]) -> dict[bytes, tuple[dict[int, str], int]]:
    out = {}
    for body in [*above, page]:
        parts = [body, *(objects.get(n, b"") for n in _listed(body, b"Resources"))]
        for part in [*parts, *(objects.get(n, b"") for p in parts for n in _listed(p, b"Font"))]:
            for name, n in re.findall(rb"/([^\s/<>\[\]()]+)\s+(\d+)\s+\d+\s+R", part):
                for m in _listed(objects.get(int(n), b""), b"ToUnicode"):
                    out[name] = _unicode(_stream(objects.get(m, b"")) or b"")
    return out


def _shown(token: bytes, font: tuple[dict[int, str], int] | None) -> str:
    if token.startswith(b"<"):
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        raw = ESCAPE.sub(lambda m: ESCAPES.get(m[1]) if m[1] in ESCAPES else bytes([int(m[1], 8) & 255]) if m[1].isdigit() else m[1], token[1:-1])
    if not font:
        return raw.decode("latin-1")
    codes, width = font
    return "".join(codes.get(int.from_bytes(raw[i : i + width], "big"), "\ufffd") for i in range(0, len(raw), width))


def _tokens(content: bytes):
    """The words of a content stream. Strings end with the bracket that closes them, or with the stream."""
    at = 0
    while m := TOKEN.search(content, at):
        begin, at = m.start(), m.end()
        if m[0] == b"(":
            depth = 1
            for x in BRACKET.finditer(content, at):
                depth += {b"(": 1, b")": -1}.get(x[0], 0)
                if not depth:
                    break
            at = x.end() if not depth else len(content)
            yield content[begin:at] if not depth else content[begin:] + b")"
        else:
            yield m[0]


def _text(content: bytes, fonts: dict) -> str:
    """What a content stream shows, by lines."""
    lines: list[str] = [""]
    before: list[bytes] = []
    font, row = None, None
    for t in _tokens(content):
        if t[:1] in b"(<[]/+-.0123456789":
            before.append(t)
            continue
        if t in (b"Tj", b"'", b'"', b"TJ"):
            if t in (b"'", b'"'):
                lines.append("")
            shown = [x for x in before if x[:1] in b"(<"]
            lines[-1] += "".join(_shown(x, font) for x in (shown if t == b"TJ" else shown[-1:]))
        elif t == b"T*" or t in (b"Td", b"TD") and before[-1:] not in ([b"0"], []):
            lines.append("")
        elif t == b"Tm":
            if row is not None and before[-1:] != row:
                lines.append("")
            row = before[-1:]
        elif t == b"Tf" and len(before) > 1:
            font = fonts.get(before[-2][1:])
        before = []
    # codes of two bytes may be halves of a character
    return "\n".join(lines).encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def read(data: bytes | None) -> tuple[list[str] | None, str | None]:
    """(pages, None), or (None, the reason)."""
    try:
        if not data or b"%PDF-" not in data[:1024]:
            raise Unread("unknown format")
        if re.search(rb"/Encrypt\s+\d+\s+\d+\s+R", data):
            raise Unread("encrypted")
        objects = _objects(data)
        pages = _pages(objects)
        if not pages:
            raise Unread("no page")
        return [_text(b"\n".join(_stream(objects.get(n, b"")) or b"" for n in _listed(page, b"Contents")), _fonts(page, above, objects)) for page, above in pages], None
    except Unread as e:
        return None, str(e)
    except (ValueError, IndexError, OverflowError, MemoryError) as e:
        return None, f"broken: {type(e).__name__}"


def pages(content: Column | str) -> Column:
    """A struct of a file's pages, or null, and the reason why it has none."""
    # rows come by the hundred, where an Arrow batch would hold ten thousand files; as it passes for not deterministic,
    # a filter on what a file has doesn't read it once more
    return F.udf(lambda x: read(bytes(x) if x is not None else None), RESULT, useArrow=False).asNondeterministic()(content)
