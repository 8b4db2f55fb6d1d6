"""PMML documents -> node tables (S3).

Documents are read as lines and cut into chunks of some ten thousand lines.
Every chunk leaves an outline, what it ends and what it leaves open; put
together in order, the outlines tell each chunk where in the tree it begins.
So the chunks are parsed in parallel, by a pull parser that emits node rows in
batches and holds one path of the open tree, and no text reaches the driver.
A document is a file, or a folder of parts (``write_forest``).  Two dialects are accepted:

* ``standard``: every Node carries the predicate that leads to it; the root
  and segments carry ``<True/>``.  The children's predicates must be
  complements (``lessOrEqual`` and ``greaterThan``, or ``lessThan`` and
  ``greaterOrEqual``, of one field and value); the smaller side is the left
  one.  As the node table sends ``x <= threshold`` left, ``lessThan t`` becomes
  the next double below t.
* ``legacy``: an inner Node carries its OWN split (its ``operator`` is not
  reliable and is ignored), leaves carry no predicate, first child = left.

Node ids are re-derived from the structure as heap ids (root 1, children
2i / 2i+1); the id attributes of the document are not trusted.
"""

from __future__ import annotations

import math
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canopy.operators.growth import NODE_SCHEMA
from canopy.operators.treejoin import joined_votes
from canopy.session import ship_package, stored
from canopy.sinks.pmml import ModelMeta

META_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("label", T.StringType()),
    T.StructField("classes", T.ArrayType(T.StringType())),
    T.StructField("regression", T.BooleanType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("algorithm", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("outputs", T.ArrayType(T.StringType())),
])
DOC_SCHEMA = T.StructType([T.StructField("path", T.StringType())] + list(NODE_SCHEMA.fields))


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _kids(el, name):
    return [c for c in el if _local(c.tag) == name]


def _meta(root) -> dict:
    dd = next(c for c in root if _local(c.tag) == "DataDictionary")
    fields = [(f.get("name"), f.get("optype"), [v.get("value") for v in _kids(f, "Value")])
              for f in _kids(dd, "DataField")]
    model = next(c for c in root if _local(c.tag) in ("MiningModel", "TreeModel"))
    predicted = [m.get("name") for ms in _kids(model, "MiningSchema") for m in _kids(ms, "MiningField")
                 if m.get("usageType") in ("predicted", "target")]
    regression = model.get("functionName") == "regression"
    categorical = [f for f in fields if f[1] == "categorical"]
    if not regression and categorical:
        label = categorical[0][0]
    else:
        label = predicted[0] if predicted else fields[-1][0]
    classes = None if regression else next((f[2] for f in fields if f[0] == label), [])
    features = [f[0] for f in fields if f[0] != label]
    header = next(iter(_kids(root, "Header")), None)
    trees = [t for t in model.iter() if _local(t.tag) == "TreeModel"]
    outputs = [o.get("name") for out in _kids(model, "Output") for o in _kids(out, "OutputField")]
    return {"features": features, "label": label, "classes": classes, "regression": regression,
            "model_name": model.get("modelName"), "algorithm": trees[0].get("algorithmName") if trees else None,
            "description": header.get("description") if header is not None else None,
            "version": root.get("version"), "outputs": outputs}


#: Operators of a split's two sides (fixed values).
SMALLER = {"lessOrEqual": "greaterThan", "lessThan": "greaterOrEqual"}


class DocumentParser:
    """Node rows of one document, fed as text in order."""

    def __init__(self, path: str = ""):
        self.path, self.pull = path, ET.XMLPullParser(("start", "end"))
        self.stack: list[ET.Element] = []
        self.open: list[dict] = []          # the Node elements not yet ended, from the root of the tree
        self.meta: dict | None = None       # known from the first Node on
        self.tree, self.dialect = -1, None

    def feed(self, text: str) -> Iterator[tuple]:
        """Rows of ``DOC_SCHEMA`` of the nodes that end in ``text``."""
        self.pull.feed(text)
        yield from self._events()

    def close(self) -> Iterator[tuple]:
        self.pull.close()
        yield from self._events()

    def _events(self) -> Iterator[tuple]:
        for event, el in self.pull.read_events():
            name = _local(el.tag)
            if event == "start":
                self._start(el, name)
            else:
                self.stack.pop()
                if name == "Node":
                    yield self._row(self.open.pop(), el)
                elif self.open and self.stack[-1] is self.open[-1]["el"]:
                    self._part(self.open[-1], el, name)
                if self.stack and name in ("Node", "Segment", "SimplePredicate", "ScoreDistribution"):
                    self.stack[-1].remove(el)  # what has been read is not kept

    def _start(self, el: ET.Element, name: str) -> None:
        up = self.open[-1] if self.open and self.stack[-1] is self.open[-1]["el"] else None
        if len(self.open) == 1 and up is not None and self.dialect is None and name != "Extension":
            self.dialect = "standard" if name == "True" else "legacy"
        self.stack.append(el)
        if name == "TreeModel":
            self.tree += 1
            self.dialect = None
        elif name == "Node":
            if self.meta is None:
                self.meta = _meta(self.stack[0])
                self.features = {f: i for i, f in enumerate(self.meta["features"])}
                self.classes = {c: i for i, c in enumerate(self.meta["classes"] or [])}
            node = {"el": el, "id": None if up else 1, "split": None, "kids": [], "counts": {}, "up": up["id"] if up else None}
            if up is not None:
                if up["id"] is None:
                    raise ValueError("a child without a split predicate")
                if self.dialect == "legacy":
                    node["id"] = 2 * up["id"] + len(up["kids"])
                up["kids"].append(node)
            self.open.append(node)

    def _part(self, node: dict, el: ET.Element, name: str) -> None:
        if name == "SimplePredicate" and node["split"] is None:
            node["split"] = (el.get("field"), el.get("operator"), float(el.get("value")))
            if node["id"] is None:
                op = node["split"][1]
                if op not in SMALLER and op not in SMALLER.values():
                    raise ValueError(f"the children's predicates are no complements: {op}")
                node["id"] = 2 * node["up"] + (op not in SMALLER)
        elif name == "ScoreDistribution":
            node["counts"][el.get("value")] = float(el.get("recordCount"))

    def _threshold(self, node: dict) -> tuple[str, float]:
        """(field, threshold) of an inner node: the larger value that goes left."""
        if self.dialect != "standard":
            if node["split"] is None:
                raise ValueError("inner node without a split predicate")
            return node["split"][0], node["split"][2]
        left, right = sorted(node["kids"], key=lambda k: k["id"] or 0)
        if left["split"] is None or right["split"] is None:
            raise ValueError("a child without a split predicate")
        (f, op, value), (g, other, same) = left["split"], right["split"]
        if SMALLER.get(op) != other or f != g or value != same:
            raise ValueError(f"the children's predicates are no complements: {left['split']} and {right['split']}")
        return f, value if op == "lessOrEqual" else math.nextafter(value, -math.inf)

    def _row(self, node: dict, el: ET.Element) -> tuple:
        i, kids = node["id"], node["kids"]
        if i is None:
            raise ValueError("a child without a split predicate")
        root = i == 1
        where = (self.path, self.tree, i, None if root else i // 2, None if root else i % 2 == 0, i.bit_length() - 1)
        count, score = el.get("recordCount"), el.get("score")
        classes = self.meta["classes"]
        if score is not None:
            score = float(self.classes[score]) if not self.meta["regression"] and score in self.classes else float(score)
        counts = [node["counts"].get(c, 0.0) for c in classes] if node["counts"] and classes else None
        facts = (score, counts, int(float(count)) if count is not None else None, None, None)
        if not kids:
            return (*where, None, None, None, None, None, *facts)
        if len(kids) != 2:
            raise ValueError("only binary splits are supported")
        name, threshold = self._threshold(node)
        for k in kids:
            k["el"] = None
        return (*where, self.features.get(name), name, threshold, 2 * i, 2 * i + 1, *facts)


def parse_document(text: str, path: str = "") -> tuple[dict, list[tuple]]:
    """One PMML document -> (meta, node rows of ``DOC_SCHEMA``)."""
    parser = DocumentParser(path)
    rows = [*parser.feed(text), *parser.close()]
    if parser.meta is None:
        raise ValueError("a document without a tree")
    return parser.meta, sorted(rows, key=lambda r: (r[1], r[2]))


#: Node rows of one batch of the parser's output.
BATCH_ROWS = 10_000
#: A chunk of a document, which a task parses by itself, ends at this many lines or characters.
CHUNK_LINES, CHUNK_CHARS = 50_000, 8 << 20
#: Characters that the parser is fed at a time.
FEED = 1 << 16

_REST = r"""(?:[^<>"']|"[^"<]*"|'[^'<]*')*"""
#: A line of text and whole tags; one with a cut tag, a comment or a declaration is none.
_WHOLE = re.compile(rf"""(?:[^<]|<[^<>"'!?\s]{_REST}>|<\?xml\s[^?<]*\?>)*""")
_TAG = re.compile(rf"""<(/?)([^<>"'!?\s/]+)({_REST})>""")

CHUNK_SCHEMA = "document string, file string, block long, chunk int, whole boolean, outline string, ended long, nodes boolean, text string"
START_SCHEMA = "document string, file string, block long, chunk int, start string, before long, first boolean, last boolean"


def document_lines(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """Lines of the documents under ``path`` (document, file, block, line), in order inside a file's block.

    A document is a file, or with ``parts`` everything under ``path`` in order of the file names.
    """
    rows = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    return rows.select((F.lit(path) if parts else F.col("file_path")).alias("document"), F.col("file_path").alias("file"),
                       F.col("file_block_start").alias("block"), F.col("value").alias("line")).where(F.trim("line") != "")


class _Element:
    """An element that is not ended: its start tag, its ended parts (name, text), and the trees that ended in it."""

    def __init__(self, name: str = "", tag: str = "", full: str = ""):
        self.name, self.tag, self.full, self.parts, self.trees = name, tag, full, [], 0


def outline(text: str) -> tuple[str, int]:
    """What a text of whole tags leaves open: (end tags of elements begun before it and start tags of those not ended, trees in ended segments).

    Both with the ended parts of the open elements; of an ended node only its
    own parts are kept, of a tree nothing.  So the outline has the size of a
    path of the tree, and that of two texts in turn is the outline of both outlines.
    """
    open_, ended = [_Element()], 0
    for m in _TAG.finditer(text):
        end, full, rest = m[1], m[2], m[3]
        name = full.rsplit(":", 1)[-1]
        if end and len(open_) == 1:
            open_[0].parts.append(("", m[0]))
            continue
        if not end:
            open_.append(_Element(name, m[0], full))
            if not rest.endswith("/"):
                continue
        el = open_.pop()
        up = open_[-1]
        if el.name == "Segment":
            ended += el.trees
            continue
        up.trees += el.trees + (el.name == "TreeModel")
        if el.name == "Node" and up.name not in ("", "Node"):
            continue  # the root of a tree
        own = "".join(t for n, t in el.parts if n != "Node" or el.name != "Node")
        up.parts.append((el.name, el.tag if not end else f"{el.tag}{own}</{el.full}>"))
    return "".join(el.tag + "".join(t for _, t in el.parts) for el in open_), ended


def document_chunks(lines: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """Chunks (document, file, block, chunk, start, before, first, last, text) of documents given as ``document_lines``.

    ``start`` is the outline of all that precedes a chunk, so a parser fed with
    it goes on as if it had read the document up to there; ``before`` counts the
    trees that the outline leaves out.  The chunk of the first node is marked
    ``first``.  Where a line is not made of whole tags, the document has no
    starts and is read by one task.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, chunk, held, size = None, 0, [], 0

        def row() -> pd.DataFrame:
            whole, text = all(_WHOLE.fullmatch(x) for x in held), "".join(held)
            left, ended = outline(text) if whole else ("", 0)
            return pd.DataFrame([(*place, chunk, whole, left, ended, re.search(r"<(\w+:)?Node[\s/>]", text) is not None, text)],
                                columns=[c.split()[0] for c in CHUNK_SCHEMA.split(", ")])

        for pdf in batches:
            for *here, line in zip(pdf["document"], pdf["file"], pdf["block"], pdf["line"]):
                if held and (here != place or len(held) >= chunk_lines or size >= CHUNK_CHARS):
                    yield row()
                    chunk, held, size = chunk + 1, [], 0
                if here != place:
                    place, chunk = here, 0
                held.append(line)
                size += len(line)
        if held:
            yield row()

    def starts(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["file", "block", "chunk"])
        out, left, before, whole, seen = [], "", 0, bool(pdf["whole"].all()), False
        for i, r in enumerate(pdf.itertuples(index=False)):
            out.append((r.document, r.file, r.block, r.chunk, left if whole else None, before, bool(r.nodes) and not seen, i == len(pdf) - 1))
            seen = seen or r.nodes
            if whole:
                left, ended = outline(left + r.outline)
                before += r.ended + ended
        return pd.DataFrame(out, columns=[c.split()[0] for c in START_SCHEMA.split(", ")])

    ship_package(lines.sparkSession)
    chunks = stored(lines.mapInPandas(cut, CHUNK_SCHEMA), "chunks")
    begun = stored(chunks.drop("text").groupBy("document").applyInPandas(starts, START_SCHEMA), "starts")
    return chunks.select("document", "file", "block", "chunk", "text").join(F.broadcast(begun), ["document", "file", "block", "chunk"])


def _whole_documents(chunks: DataFrame) -> DataFrame:
    """The chunks of documents without starts, each document in one task and in order."""
    return (chunks.where("start IS NULL").repartition("document").sortWithinPartitions("document", "file", "block", "chunk")
            .select("document", "last", "text"))


def _begun(document: str, start: str, before: int) -> DocumentParser:
    """A parser that has read a document up to a chunk."""
    parser = DocumentParser(document)
    parser.tree = before - 1
    for _ in parser.feed(start):
        pass
    return parser


def _fed(parser: DocumentParser, text: str) -> Iterator[tuple]:
    for at in range(0, len(text), FEED):
        yield from parser.feed(text[at:at + FEED])


def parsed_chunks(chunks: DataFrame) -> DataFrame:
    """Node rows (``path`` + NODE_SCHEMA) of documents given as ``document_chunks``, every chunk parsed on its own; a node belongs to the chunk that ends it."""
    def batched(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        some = []
        for r in rows:
            some.append(r)
            if len(some) >= BATCH_ROWS:
                yield pd.DataFrame(some, columns=DOC_SCHEMA.fieldNames())
                some = []
        yield pd.DataFrame(some, columns=DOC_SCHEMA.fieldNames())

    def some(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for pdf in batches:
            for document, start, before, last, text in zip(pdf["document"], pdf["start"], pdf["before"], pdf["last"], pdf["text"]):
                parser = _begun(document, start, before)
                yield from _fed(parser, text)
                if last:
                    yield from parser.close()

    def all_(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        parser = None
        for pdf in batches:
            for document, last, text in zip(pdf["document"], pdf["last"], pdf["text"]):
                if parser is None or parser.path != document:
                    parser = DocumentParser(document)
                yield from _fed(parser, text)
                if last:
                    yield from parser.close()

    ship_package(chunks.sparkSession)
    cut = chunks.where("start IS NOT NULL").select("document", "start", "before", "last", "text")
    return cut.mapInPandas(lambda b: batched(some(b)), DOC_SCHEMA).unionByName(_whole_documents(chunks).mapInPandas(lambda b: batched(all_(b)), DOC_SCHEMA))


def chunks_meta(chunks: DataFrame) -> DataFrame:
    """One meta row (META_SCHEMA) per document given as ``document_chunks``: from the chunk of its first node."""
    def found(parser: DocumentParser) -> tuple:
        return (parser.path, *[parser.meta[f] for f in META_SCHEMA.fieldNames()[1:]])

    def some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for document, start, before, text in zip(pdf["document"], pdf["start"], pdf["before"], pdf["text"]):
                parser = _begun(document, start, before)
                for at in range(0, len(text), FEED):
                    if parser.meta is None:
                        for _ in parser.feed(text[at:at + FEED]):
                            pass
                out += [found(parser)] if parser.meta is not None else []
            yield pd.DataFrame(out, columns=META_SCHEMA.fieldNames())

    def all_(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser, done = None, None
        for pdf in batches:
            out = []
            for document, text in zip(pdf["document"], pdf["text"]):
                if document == done:
                    continue
                if parser is None or parser.path != document:
                    parser = DocumentParser(document)
                for _ in _fed(parser, text):
                    pass
                if parser.meta is not None:
                    done = document
                    out.append(found(parser))
            yield pd.DataFrame(out, columns=META_SCHEMA.fieldNames())

    ship_package(chunks.sparkSession)
    first = chunks.where("start IS NOT NULL AND first").select("document", "start", "before", "text")
    return first.mapInPandas(some, META_SCHEMA).unionByName(_whole_documents(chunks).mapInPandas(all_, META_SCHEMA))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (path, value)."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")


def pmml_nodes(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Document rows -> node rows (``path`` + NODE_SCHEMA), parsed in tasks."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            paths = pdf["path"] if "path" in pdf else [""] * len(pdf)
            for p, text in zip(paths, pdf[text_col]):
                out.extend(parse_document(text, p)[1])
            yield pd.DataFrame(out, columns=DOC_SCHEMA.fieldNames())

    ship_package(docs.sparkSession)
    src = docs if "path" in docs.columns else docs.withColumn("path", F.lit(""))
    return src.select("path", text_col).mapInPandas(parse, DOC_SCHEMA)


def pmml_meta(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Document rows -> one meta row each (features, label, classes)."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            paths = pdf["path"] if "path" in pdf else [""] * len(pdf)
            for p, text in zip(paths, pdf[text_col]):
                m = parse_document(text, p)[0]
                out.append((p, *[m[f] for f in META_SCHEMA.fieldNames()[1:]]))
            yield pd.DataFrame(out, columns=META_SCHEMA.fieldNames())

    ship_package(docs.sparkSession)
    return docs.select("path", text_col).mapInPandas(parse, META_SCHEMA)


def model_meta(m: dict) -> ModelMeta:
    """A row of META_SCHEMA as the settings of a document."""
    return ModelMeta(tuple(m["features"]), m["label"], None if m["regression"] else tuple(m["classes"]),
                     **{k: m[k] for k in ("model_name", "algorithm", "description", "version") if m[k] is not None})


def forest_from_pmml(spark: SparkSession, path: str) -> tuple[DataFrame, ModelMeta]:
    """S3: ONE document, a file or parts in order under ``path`` -> (node table, meta).

    Several documents under ``path`` are refused (``documents_from_pmml``
    keeps them apart).  The nodes are parsed once, chunk by chunk, into a table.
    """
    lines = document_lines(spark, path, parts=True)
    begun = lines.where(F.col("line").rlike("<(\\w+:)?PMML[\\s>]")).count()
    if begun != 1:
        raise ValueError(f"{'several' if begun else 'no'} documents under {path}")
    chunks = document_chunks(lines)
    nodes = stored(parsed_chunks(chunks).drop("path"), "nodes")
    return nodes, model_meta(chunks_meta(chunks).first().asDict())


def documents_from_pmml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S3: every document (file) under ``path`` -> (node rows with ``path``, meta rows)."""
    chunks = document_chunks(document_lines(spark, path))
    return stored(parsed_chunks(chunks), "nodes"), stored(chunks_meta(chunks), "meta")


def score_documents(df: DataFrame, nodes: DataFrame, meta: DataFrame) -> DataFrame:
    """Every row of ``df`` scored by every document of ``documents_from_pmml``: its columns, ``path`` and ``prediction``.

    The models stay tables (one join per level of a tree); only their names,
    numbers of trees and class counts reach the driver.  Majority vote (ties ->
    lowest class) or mean, as the document says.
    """
    models = {r["path"]: r for r in meta.collect()}
    sizes = {r["path"]: r["trees"] for r in nodes.groupBy("path").agg((F.max("tree_id") + 1).alias("trees")).collect()}
    first, total = {}, 0
    for p in sorted(sizes):
        first[p], total = total, total + sizes[p]
    start = F.coalesce(*[F.when(F.col("path") == p, F.lit(k)) for p, k in first.items()])
    scored, names = joined_votes(df, nodes.withColumn("tree_id", F.col("tree_id") + start))
    entries = []
    for p, k in first.items():
        votes = F.array_compact(F.array(*names[k:k + sizes[p]]))
        if models[p]["regression"]:
            vote = F.aggregate(votes, F.lit(0.0), lambda acc, v: acc + v) / F.nullif(F.size(votes), F.lit(0))
        else:
            # a NULL vote counts for none; the first of the largest counts wins
            counts = F.transform(F.sequence(F.lit(0), F.lit(len(models[p]["classes"]) - 1)),
                                 lambda c: F.struct(F.size(F.filter(votes, lambda v: v == c)).alias("n"), (-c).alias("k")))
            vote = F.when(F.size(votes) > 0, (-F.array_max(counts)["k"]).cast("double"))
        entries.append(F.struct(F.lit(p).alias("path"), vote.alias("prediction")))
    own = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    return scored.select(*own, F.explode(F.array(*entries)).alias("__e")).select(*own, "__e.path", "__e.prediction")
