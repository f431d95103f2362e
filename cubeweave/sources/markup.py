"""XML text as a table of its elements, at any depth, in one pass over the documents.

A fixed schema would have to name every level of groups and aggregations that
a document may nest. Here each document is parsed once, a batch of
documents at a time, and every element becomes a row: none is left out because it is
deep or unknown. Nothing is shuffled, and a task holds one document's tree and the rows of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame

_COLUMNS = {
    "path": "string", "element": "string", "ordinal": "int", "place": "int", "given": "map<string,string>", "text": "string",
    "outer": "string", "outer_given": "map<string,string>", "holder": "string",
}


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


class _Elements:
    """The elements of a batch of documents, by column."""

    def __init__(self) -> None:
        self.document, self.path, self.element, self.ordinal, self.place, self.text, self.outer, self.holder = ([] for _ in range(8))
        # the XML attributes of all elements, and where those of each start
        self.starts, self.names, self.values = [0], [], []

    def add(self, document: int, path: str, element: str, ordinal: int, place: int, given: dict, text: str | None, outer: int | None, holder: int | None) -> int:
        """Add one element; outer and holder are the rows of those around it. The new row."""
        self.document.append(document)
        self.path.append(path)
        self.element.append(element)
        self.ordinal.append(ordinal)
        self.place.append(place)
        self.text.append(text)
        self.outer.append(outer)
        self.holder.append(holder)
        self.names += given
        self.values += given.values()
        self.starts.append(len(self.names))
        return len(self.path) - 1

    def read(self, document: int, xml: str) -> None:
        """All elements of one document, in its order; text that is no document is one element, ``unreadable``."""
        try:
            root = ElementTree.fromstring(xml.encode())
        except ElementTree.ParseError as error:
            self.add(document, "", "unreadable", 0, 0, {}, str(error), None, None)
            return
        place = 0
        # each with its name, place among its like, path, and the rows around it
        left = [(root, _local(root.tag), 0, f"/{_local(root.tag)}", None, None)]
        while left:
            e, name, ordinal, path, outer, holder = left.pop()
            row = self.add(document, path, name, ordinal, place, {_local(k): v for k, v in e.items()}, (e.text or "").strip() or None, outer, holder)
            place += 1
            if len(e):
                count, below = {}, []
                for child in e:
                    called = _local(child.tag)
                    i = count.get(called, 0)
                    count[called] = i + 1
                    below.append((child, called, i, f"{path}/{called}[{i}]", row, outer))
                left += reversed(below)

    def arrays(self) -> list[pa.Array]:
        path, outer = pa.array(self.path, pa.string()), pa.array(self.outer, pa.int64())
        given = pa.MapArray.from_arrays(pa.array(self.starts, pa.int32()), pa.array(self.names, pa.string()), pa.array(self.values, pa.string()))
        return [
            path, pa.array(self.element, pa.string()), pa.array(self.ordinal, pa.int32()), pa.array(self.place, pa.int32()), given,
            pa.array(self.text, pa.string()), path.take(outer), given.take(outer), path.take(pa.array(self.holder, pa.int64())),
        ]


def elements(docs: DataFrame, key: str = "doc_id", xml: str = "xml") -> DataFrame:
    """One row for each element of every document.

    Columns: the key; path (``/netcdf/aggregation[0]/scan[1]``: places among
    siblings of the same name); element; ordinal (the last of these places);
    place (in document order); given (its XML attributes); text; outer and
    outer_given (path and XML attributes of the element around it); holder (path of the one around that).
    Name spaces are left out. A null text has no rows; a text that can not be
    parsed has one, the element ``unreadable`` with the reason as its text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _Elements()
            for i, text in enumerate(batch.column("xml").to_pylist()):
                if text is not None:
                    found.read(i, text)
            yield pa.record_batch([batch.column(key).take(pa.array(found.document, pa.int64())), *found.arrays()], names=[key, *_COLUMNS])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, docs[xml].alias("xml")).mapInArrow(run, f"{key} {kind}, " + ", ".join(f"{n} {t}" for n, t in _COLUMNS.items()))
