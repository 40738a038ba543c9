"""What several test modules share: landed files, the test tables and rows in order."""

from __future__ import annotations

import os

from landfall.plans.loads import PAYLOAD, ROW_TAG

SF = "/root/testdata/sf0.001"


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return path


def response(*payloads):
    """A landed document; ``None`` leaves the payload element out."""
    rows = "".join(
        f'<{ROW_TAG}><status xsi:type="xsd:int">1</status>'
        + ("" if p is None else f'<{PAYLOAD} xsi:type="xsd:string">{p}</{PAYLOAD}>')
        + f"</{ROW_TAG}>\n"
        for p in payloads
    )
    return (
        '<env:Envelope xmlns:env="http://e" xmlns:ns1="urn:x" '
        f'xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"><env:Body>\n{rows}</env:Body></env:Envelope>\n'
    )


def rows(df, *columns):
    """The rows as a sorted list of tuples, so that frames compare as multisets."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))
