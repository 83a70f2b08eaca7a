"""Downloads of manuals on the driver: bounded, hashed, checked by signature, one member of an archive, published whole."""

from __future__ import annotations

import hashlib
import json
import re
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path
from typing import BinaryIO
from urllib.parse import unquote, urlsplit
from urllib.request import urlopen

#: How the kinds of documents begin, and where pages of documents lead to.
SIGNATURES = {".pdf": b"%PDF-", ".chm": b"ITSF"}
DOCUMENT_PAGE = r"/enterprise/(?:en|zh)/doc/(EDOC\d+)/?"
DOCUMENT_HOST = "support.huawei.com"
DOWNLOAD = "https://download.huawei.com/edownload/e/download.do?actionFlag=download&nid={}&partNo=6001&mid=SUPE_DOC"
CHUNK = 1 << 20


def download_url(url: str) -> str:
    """Where a URL's document lies: a document page's package, else the URL itself."""
    u = urlsplit(url)
    if u.scheme not in ("http", "https") or not u.hostname:
        raise ValueError(f"not a web address: {url}")
    page = re.fullmatch(DOCUMENT_PAGE, u.path) if u.hostname == DOCUMENT_HOST else None
    return DOWNLOAD.format(page[1]) if page else url


def bounded(source: BinaryIO, target: Path, most: int) -> str:
    """Copies at most `most` bytes, else fails; returns their SHA-256."""
    digest, left = hashlib.sha256(), most
    with target.open("wb") as out:
        for part in iter(lambda: source.read(CHUNK), b""):
            left -= len(part)
            if left < 0:
                raise ValueError(f"more than {most} bytes")
            digest.update(part)
            out.write(part)
    return digest.hexdigest()


def member_of(names: list[str], suffix: str, wanted: str | None) -> str:
    """The one document of an archive: the one asked for, else the only one, else the only whole command reference."""
    fit = [n for n in names if n.lower().endswith(suffix)]
    named = [n for n in fit if n == wanted] if wanted else fit
    if len(named) > 1:
        named = [n for n in fit if re.search(r"command reference\.pdf$", n, re.I)]
    if len(named) != 1:
        raise ValueError(f"name one {suffix} member of the archive: {', '.join(fit) or 'it has none'}")
    return named[0]


def require_hash(found: str, expected: str | None, what: str) -> None:
    if expected and found != expected.lower():
        raise ValueError(f"the SHA-256 of the {what} is {found}")


def fetch(url: str, output: Path, *, member: str | None = None, sha256: str | None = None, document_sha256: str | None = None, max_bytes: int = 4 << 30, opener: Callable[[str], BinaryIO] = urlopen) -> dict:
    """Writes the document of a URL, and `.source.json` on where it comes from; neither may be there yet, and on an error neither is left."""
    output, note = Path(output), Path(output).with_suffix(".source.json")
    suffix = output.suffix.lower()
    if suffix not in SIGNATURES:
        raise ValueError("the output must end in .pdf or .chm")
    if max_bytes < 1 or any(h and not re.fullmatch("[0-9a-fA-F]{64}", h) for h in (sha256, document_sha256)):
        raise ValueError("max_bytes must be positive, and hashes have 64 hexadecimal digits")
    if output.exists() or note.exists():
        raise ValueError(f"{output} or {note} exists already")
    address = download_url(url)
    output.parent.mkdir(parents=True, exist_ok=True)
    with tempfile.TemporaryDirectory(dir=output.parent) as folder:
        got, document = Path(folder, "got"), Path(folder, "document")
        with opener(address) as response:
            digest = bounded(response, got, max_bytes)
        require_hash(digest, sha256, "download")
        if zipfile.is_zipfile(got):
            with zipfile.ZipFile(got) as z:
                member = member_of(z.namelist(), suffix, member)
                with z.open(member) as source:
                    inner = bounded(source, document, max_bytes)
        elif member:
            raise ValueError("only archives have members")
        else:
            inner, document = digest, got
        with document.open("rb") as f:
            if not f.read(8).startswith(SIGNATURES[suffix]):
                raise ValueError(f"not a {suffix} document; perhaps a login page")
        require_hash(inner, document_sha256, "document")
        said = {"url": url, "download_url": address, "member": member, "sha256": digest, "document_sha256": inner, "fetched": datetime.now(UTC).isoformat(), "name": Path(unquote(urlsplit(address).path)).name}
        Path(folder, "note").write_text(json.dumps(said, indent=2) + "\n", encoding="utf-8")
        shutil.move(document, output)
        shutil.move(Path(folder, "note"), note)
    return said
