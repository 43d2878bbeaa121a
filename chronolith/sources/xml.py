"""Marked-up debates and taxonomies as rows; a document is parsed whole, in Arrow batches on the executors."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Kinds of parts that a debate is made of, in the order of nesting.
PARTS = ("debateSection", "speech", "question", "summary", "division")


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _text(node) -> str:
    return " ".join(" ".join(node.itertext()).split())


def debate_parts(docs: DataFrame, uri: str = "uri", content: str = "content") -> DataFrame:
    """Rows (uri, ordinal, kind, eid, parent, by, role, at, text, error) of debate documents.

    ``ordinal``: place among the parts of one container, from 1; ``parent``: eId of the nearest enclosing part;
    ``text``: own words of speeches, questions and summaries. A document that doesn't parse gives one row with
    its error and nothing else, so it can be quarantined; null contents give none.
    """
    schema = "uri string, ordinal int, kind string, eid string, parent string, by string, role string, at string, text string, error string"

    def rows_of(key: str, raw) -> list[tuple]:
        try:
            root = ET.fromstring(raw)
        except ET.ParseError as e:
            return [(key, None, None, None, None, None, None, None, None, str(e))]
        out: list[tuple] = []
        todo = [(root, None, [0])]
        while todo:
            node, parent, place = todo.pop()
            kind = _local(node.tag)
            inside, count = parent, place
            if kind in PARTS:
                place[0] += 1
                inside, count = node.get("eId"), [0]
                own = _text(node) if kind in ("speech", "question", "summary") else None
                times = [x.get("time") for x in node if _local(x.tag) == "recordedTime"]
                out.append((key, place[0], kind, node.get("eId"), parent, node.get("by"), node.get("as"), times[0] if times else None, own, None))
            todo.extend((c, inside, count) for c in reversed(list(node)))
        return out

    def parse(frames):
        for f in frames:
            rows = [r for key, raw in zip(f["uri"], f["content"]) if raw is not None for r in rows_of(key, bytes(raw))]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")]).astype({"ordinal": "Int32"})

    return docs.select(F.col(uri).alias("uri"), F.col(content).cast("binary").alias("content")).mapInPandas(parse, schema)


def divisions(docs: DataFrame, uri: str = "uri", content: str = "content") -> DataFrame:
    """Rows (uri, division, side, member): the votes of each division, by the lists of ta, nil and staon."""
    def parse(frames):
        for f in frames:
            rows = []
            for key, raw in zip(f["uri"], f["content"]):
                if raw is None:
                    continue
                try:
                    root = ET.fromstring(bytes(raw))
                except ET.ParseError:
                    continue
                for d in (x for x in root.iter() if _local(x.tag) == "division"):
                    for side in (x for x in d.iter() if _local(x.tag) in ("ta", "nil", "staon")):
                        rows += [(key, d.get("eId"), _local(side.tag), p.get("refersTo")) for p in side.iter() if _local(p.tag) == "person"]
            yield pd.DataFrame(rows, columns=["uri", "division", "side", "member"])

    x = docs.select(F.col(uri).alias("uri"), F.col(content).cast("binary").alias("content"))
    return x.mapInPandas(parse, "uri string, division string, side string, member string")


def taxonomy(docs: DataFrame, content: str = "content", lang: str = "en", status: str = "CURRENT") -> DataFrame:
    """Rows (concept, label, preferred, broader) of SKOS concepts: labels of one language, only of the given status
    (concepts that state none count); a row for each label and broader concept, whichever there are more of."""
    def parse(frames):
        for f in frames:
            rows = []
            for raw in f["content"]:
                if raw is None:
                    continue
                root = ET.fromstring(bytes(raw))
                texts = {}
                for node in root.iter():
                    if _local(node.tag) == "Label":
                        about = next((v for k, v in node.attrib.items() if _local(k) == "about"), None)
                        for form in (x for x in node if _local(x.tag) == "literalForm"):
                            texts[about] = (form.text, next((v for k, v in form.attrib.items() if _local(k) == "lang"), None))
                for c in (x for x in root.iter() if _local(x.tag) == "Concept"):
                    about = next((v for k, v in c.attrib.items() if _local(k) == "about"), None)
                    stated = [x.text or next(iter(x.attrib.values()), "") for x in c if _local(x.tag) == "status"]
                    if stated and not any(s.rsplit("/", 1)[-1] == status for s in stated):
                        continue
                    up = [next((v for k, v in x.attrib.items() if _local(k) == "resource"), None) for x in c if _local(x.tag) == "broader"]
                    labels = []
                    for x in c:
                        kind = _local(x.tag)
                        if kind not in ("prefLabel", "altLabel"):
                            continue
                        ref = next((v for k, v in x.attrib.items() if _local(k) == "resource"), None)
                        text, own = texts.get(ref, (None, None)) if ref else (x.text, next((v for k, v in x.attrib.items() if _local(k) == "lang"), None))
                        if text and own == lang:
                            labels.append((text, kind == "prefLabel"))
                    rows += [(about, text, first, b) for text, first in labels for b in up or [None]]
            yield pd.DataFrame(rows, columns=["concept", "label", "preferred", "broader"])

    return docs.select(F.col(content).cast("binary").alias("content")).mapInPandas(parse, "concept string, label string, preferred boolean, broader string")
