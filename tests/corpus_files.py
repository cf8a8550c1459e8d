"""Writes small manifests, packages and archives for the tests."""

import hashlib
import io
import tarfile
from pathlib import Path


def article(
    pmcid, title="A title", body="Some text.", pmid=None, doi=None, front="", extra="", year="2024",
):
    ids = f'<article-id pub-id-type="pmc">{pmcid}</article-id>' if pmcid else ""
    if pmid:
        ids += f'<article-id pub-id-type="pmid">{pmid}</article-id>'
    if doi:
        ids += f'<article-id pub-id-type="doi">{doi}</article-id>'
    return f"""<article xmlns:xlink="http://www.w3.org/1999/xlink">
  <front>
    {front}
    <article-meta>
      {ids}
      <title-group><article-title>{title}</article-title></title-group>
      <pub-date><year>{year}</year></pub-date>
      {extra}
    </article-meta>
  </front>
  <body><p>{body}</p></body>
</article>"""


def write_archive(path, members):
    """A .tar.gz of {member name: text or bytes}; returns its MD5 digest."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, "w:gz") as tar:
        for name, text in members.items():
            data = text if isinstance(text, bytes) else text.encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return hashlib.md5(path.read_bytes()).hexdigest()


HEADER = "File,Accession ID,PMID,Last Updated,Retracted"


def write_list(path, rows, header=HEADER):
    """A manifest or file list of (file, id, pmid, time, retracted) rows."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *[",".join(row) for row in rows]]) + "\n")
    return str(path)


def write_package(drop, day, members, rows, area="oa_comm"):
    """A dated package and its file list; `rows` are (id, time, retracted)."""
    folder = Path(drop) / "oa_bulk" / area / "xml"
    name = f"{area}_xml.incr.{day}"
    write_archive(folder / f"{name}.tar.gz", members)
    if rows is not None:
        write_list(
            folder / f"{name}.filelist.csv",
            [(f"{name}.tar.gz", pmcid, "", time, retracted) for pmcid, time, retracted in rows],
        )
    return f"oa_bulk/{area}/xml/{name}.tar.gz"
