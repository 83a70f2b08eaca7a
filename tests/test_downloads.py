import hashlib
import io
import zipfile

import pytest

from quarry.sources import downloads as D

PDF = b"%PDF-1.4 x"


def packed(**members):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for name, data in members.items():
            z.writestr(name.replace("_", " ") + ".pdf", data)
    return b.getvalue()


def get(tmp_path, data, **more):
    return D.fetch("https://h/x.bin", tmp_path / "o.pdf", opener=lambda u: io.BytesIO(data), **more)


def test_plain_and_archive(tmp_path):
    assert get(tmp_path / "a", PDF)["document_sha256"] == hashlib.sha256(PDF).hexdigest()
    z = packed(Guide=b"no", Command_Reference=PDF)
    assert get(tmp_path / "b", z)["member"] == "Command Reference.pdf"
    assert (tmp_path / "b" / "o.pdf").read_bytes() == PDF and (tmp_path / "b" / "o.source.json").exists()


@pytest.mark.parametrize(("data", "more", "says"), [(b"<html>", {}, "login"), (PDF, {"sha256": "0" * 64}, "SHA-256"), (PDF, {"max_bytes": 3}, "more than"), (PDF, {"member": "x"}, "members"), (packed(a=PDF, b=PDF), {}, "name one")])
def test_nothing_is_left_of_failures(tmp_path, data, more, says):
    with pytest.raises(ValueError, match=says):
        get(tmp_path, data, **more)
    assert list(tmp_path.iterdir()) == []


def test_urls():
    assert "nid=EDOC11" in D.download_url("https://support.huawei.com/enterprise/en/doc/EDOC11")
    assert D.download_url("http://h/a?b") == "http://h/a?b"
    with pytest.raises(ValueError, match="web"):
        D.download_url("file:///x")
