"""Documents checked against a schema: its types are read once and become a table of rules and Column predicates, and every element of every document is a row that they are applied to.

What is read of a schema: named and inline simple and complex types, restrictions (enumeration, pattern, bounds, lengths) over named or built-in types, sequences and choices with their numbers of occurrence,
references, attributes, extensions and includes. A schema is a few files, read by the driver; documents are walked where they lie."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

XS = "{http://www.w3.org/2001/XMLSchema}"
INTEGER, NAME = r"[+-]?[0-9]+", r"[\p{L}_][\p{L}\p{N}._-]*"
#: Built-in types: what their text looks like, and the least and greatest number.
BUILT_IN = {
    "string": (None, None, None), "token": (None, None, None), "normalizedString": (None, None, None), "anyURI": (None, None, None), "anySimpleType": (None, None, None), "integer": (INTEGER, None, None), "int": (INTEGER, -(2**31), 2**31 - 1),
    "long": (INTEGER, -(2**63), 2**63 - 1), "short": (INTEGER, -(2**15), 2**15 - 1), "nonNegativeInteger": (INTEGER, 0, None), "positiveInteger": (INTEGER, 1, None), "unsignedInt": (INTEGER, 0, 2**32 - 1), "decimal": (r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)", None, None),
    "double": (r"([+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?INF|NaN)", None, None), "boolean": ("true|false|0|1", None, None), "date": (r"-?[0-9]{4,}-[0-9]{2}-[0-9]{2}(Z|[+-][0-9]{2}:[0-9]{2})?", None, None),
    "gYear": (r"-?[0-9]{4,}", None, None), "ID": (NAME, None, None), "IDREF": (NAME, None, None), "NCName": (NAME, None, None), "NMTOKEN": (r"[\p{L}\p{N}._:-]+", None, None), "language": (r"[a-zA-Z]{1,8}(-[a-zA-Z0-9]{1,8})*", None, None),
}


@dataclass
class Complex:
    """children: name to (type, place in the sequence, least and most occurrences, None for any number). choices: sets of which one must be there. text: the type of its text, if it has any."""

    children: dict[str, tuple[str, int, int, int | None]] = field(default_factory=dict)
    choices: list[list[str]] = field(default_factory=list)
    attributes: dict[str, tuple[str, bool]] = field(default_factory=dict)
    text: str | None = None


@dataclass
class Schema:
    elements: dict[str, str] = field(default_factory=dict)
    complex: dict[str, Complex] = field(default_factory=dict)
    simple: dict[str, tuple[str, dict[str, list[str]]]] = field(default_factory=dict)


def _local(name: str) -> str:
    return name.rpartition(":")[2]


def read_schema(spark: SparkSession, *paths: str) -> Schema:
    """The schema of files and all that they include."""
    roots, todo, seen = [], list(paths), set()
    while todo:
        path = todo.pop()
        if path in seen:
            continue
        seen.add(path)
        root = ElementTree.fromstring(spark.read.text(path, wholetext=True).first()[0])
        roots.append(root)
        todo += [path.rpartition("/")[0] + "/" + i.get("schemaLocation") for i in root.iter(f"{XS}include")]
    s = Schema()
    typed = {r.get("name"): r for root in roots for r in root if r.tag == f"{XS}complexType"}
    for root in roots:
        for e in root:
            if e.tag == f"{XS}simpleType":
                _simple(s, e, e.get("name"))
            elif e.tag == f"{XS}element":
                s.elements[e.get("name")] = _type_of(s, e, typed, e.get("name"))
    for name, e in typed.items():
        _complex(s, e, name, typed)
    return s


def _simple(s: Schema, e: ElementTree.Element, name: str) -> str:
    r = e.find(f"{XS}restriction")
    facets: dict[str, list[str]] = {}
    for f in r if r is not None else ():
        facets.setdefault(f.tag.removeprefix(XS), []).append(f.get("value"))
    s.simple[name] = (_local(r.get("base")) if r is not None else "string", facets)
    return name


def _type_of(s: Schema, e: ElementTree.Element, typed: dict, where: str) -> str:
    if e.get("type"):
        return _local(e.get("type"))
    if (inner := e.find(f"{XS}simpleType")) is not None:
        return _simple(s, inner, f"{where}#")
    if (inner := e.find(f"{XS}complexType")) is not None:
        _complex(s, inner, f"{where}#", typed)
        return f"{where}#"
    return "string"


def _complex(s: Schema, e: ElementTree.Element, name: str, typed: dict) -> Complex:
    if name in s.complex:
        return s.complex[name]
    c = s.complex[name] = Complex()

    def particles(group: ElementTree.Element, optional: bool, many: bool, choice: list[str] | None) -> None:
        for p in group:
            least, most = int(p.get("minOccurs", 1)), p.get("maxOccurs", "1")
            repeated = many or most != "1"
            if p.tag == f"{XS}element":
                child = _local(p.get("ref") or p.get("name"))
                kind = f"@{child}" if p.get("ref") else _type_of(s, p, typed, f"{name}.{child}")
                c.children[child] = (kind, len(c.children), 0 if optional or choice is not None else least, None if repeated else 1)
                if choice is not None:
                    choice.append(child)
            elif p.tag in (f"{XS}sequence", f"{XS}all"):
                particles(p, optional or least == 0, repeated, choice)
            elif p.tag == f"{XS}choice":
                options: list[str] = choice if choice is not None else []
                particles(p, True, repeated, options)
                if choice is None and least and not optional:
                    c.choices.append(options)

    def attributes(holder: ElementTree.Element) -> None:
        for a in holder.findall(f"{XS}attribute"):
            attribute = a.get("name") or _local(a.get("ref"))
            c.attributes[attribute] = (_type_of(s, a, typed, f"{name}@{attribute}"), a.get("use") == "required")

    body = e
    for content in (f"{XS}simpleContent", f"{XS}complexContent"):
        if (inner := e.find(content)) is not None:
            body = inner[0]
            base = _local(body.get("base"))
            if base in typed:
                b = _complex(s, typed[base], base, typed)
                c.children, c.choices, c.attributes, c.text = dict(b.children), list(b.choices), dict(b.attributes), b.text
            else:
                c.text = base
    if e.get("mixed") == "true":
        c.text = "string"
    for group in body:
        if group.tag in (f"{XS}sequence", f"{XS}all", f"{XS}choice"):
            wrapped = ElementTree.Element("group")
            wrapped.append(group)
            particles(wrapped, False, False, None)
    attributes(body)
    return c


def holds(schema: Schema, kind: Column, value: Column) -> Column:
    """Whether a text is of a simple type (its name in kind): null for a type that is not known."""
    out = F.lit(None).cast("boolean")
    for name in [*BUILT_IN, *schema.simple]:
        out = F.when(kind == name, _holds(schema, name, value)).otherwise(out)
    return out


def _holds(schema: Schema, name: str, value: Column) -> Column:
    v = F.trim(F.regexp_replace(value, r"\s+", " ")) if name != "string" else value
    if name in BUILT_IN:
        shape, low, high = BUILT_IN[name]
        number = v.try_cast("decimal(38,10)")
        tests = [v.rlike(f"^(?:{shape})$")] if shape else []
        tests += [number >= low] if low is not None else []
        tests += [number <= high] if high is not None else []
    elif name in schema.simple:
        base, facets = schema.simple[name]
        number = v.try_cast("decimal(38,10)")
        tests = [_holds(schema, base, value)]
        tests += [v.isin(*facets["enumeration"])] if "enumeration" in facets else []
        tests += [v.rlike("^(?:" + "|".join(f"(?:{p})" for p in facets["pattern"]) + ")$")] if "pattern" in facets else []
        compare = {"minInclusive": lambda a, b: a >= b, "maxInclusive": lambda a, b: a <= b, "minExclusive": lambda a, b: a > b, "maxExclusive": lambda a, b: a < b}
        tests += [compare[f](number, F.lit(facets[f][0]).cast("decimal(38,10)")) for f in compare if f in facets]
        size = {"minLength": lambda n, b: n >= b, "maxLength": lambda n, b: n <= b, "length": lambda n, b: n == b}
        tests += [size[f](F.length(v), int(facets[f][0])) for f in size if f in facets]
    else:
        return F.lit(None).cast("boolean")
    out = F.lit(True)
    for t in tests:
        out = out & F.coalesce(t, F.lit(False))
    return out


def _walk(schema: Schema, xml: str) -> Iterator[tuple]:
    """(path, type or null, text, attributes, children) of every element; below an unknown one nothing is told."""

    def kind_of(kind: str) -> str | None:
        return schema.elements.get(kind[1:]) if kind.startswith("@") else kind

    root = ElementTree.fromstring(xml)
    todo = [("", root, schema.elements.get(root.tag.rpartition("}")[2]))]
    while todo:
        path, e, kind = todo.pop()
        name = e.tag.rpartition("}")[2]
        yield f"{path}/{name}", kind, e.text or "", [(k, v) for k, v in e.attrib.items() if not k.startswith("{")], [x.tag.rpartition("}")[2] for x in e]
        known = schema.complex.get(kind)
        if known:
            for x in reversed(e):
                child = known.children.get(x.tag.rpartition("}")[2])
                if child:
                    todo.append((f"{path}/{name}", x, kind_of(child[0])))


def document_problems(docs: DataFrame, schema: Schema, id: str = "id", xml: str = "xml") -> DataFrame:
    """id, path, problem: what of each document the schema does not allow, a row each; documents that are no XML have one row without a path."""
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = [pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.list_(pa.string())]
        for b in batches:
            for key, text in zip(b.column(0), b.column(1).to_pylist()):
                try:
                    rows = list(_walk(schema, text or ""))
                except ElementTree.ParseError:
                    rows = [(None, None, None, [], [])]
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(rows), b.column(0).type), *(pa.array(c, t) for c, t in zip(zip(*rows), shape))], ["id", "path", "type", "text", "attributes", "children"])

    found = docs.select(F.col(id), F.col(xml)).mapInArrow(run, f"id {kind}, path string, type string, text string, attributes map<string,string>, children array<string>")
    rules = [(n, {k: (t, i) for k, (t, i, _, _) in c.children.items()}, [k for k, v in c.children.items() if v[2]], [k for k, v in c.children.items() if v[3] == 1], c.choices, {k: t for k, (t, _) in c.attributes.items()}, [k for k, (_, u) in c.attributes.items() if u], c.text) for n, c in schema.complex.items()]
    rules = docs.sparkSession.createDataFrame(
        [(n, {k: i for k, (_, i) in ch.items()}, need, once, choices, attrs, must, text) for n, ch, need, once, choices, attrs, must, text in rules],
        "rule string, places map<string,int>, needed array<string>, once array<string>, choices array<array<string>>, kinds map<string,string>, must array<string>, body string")
    j = found.join(rules, F.col("type") == F.col("rule"), "left")
    names = F.map_keys("attributes")
    told = lambda items, before: F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.concat(F.lit(before), x))
    places = F.filter(F.transform("children", lambda c: F.try_element_at("places", c)), lambda p: p.isNotNull())
    count = lambda n: F.size(F.filter("children", lambda c: c == n))
    value = F.transform(F.filter(F.map_entries("attributes"), lambda a: ~F.coalesce(holds(schema, F.try_element_at("kinds", a["key"]), a["value"]), F.lit(True))), lambda a: F.concat(a["key"], F.lit(" is no "), F.try_element_at("kinds", a["key"]), F.lit(": "), a["value"]))
    body = F.when(F.col("rule").isNull(), F.col("type")).otherwise(F.col("body"))
    wrong = F.when(~F.coalesce(holds(schema, body, F.col("text")), F.lit(True)), F.array(F.concat(F.lit("no "), body, F.lit(": "), F.col("text"))))
    within = F.col("rule").isNotNull()
    structure = F.concat(
        told(F.array_except("needed", "children"), "lacks "), told(F.array_except("children", F.map_keys("places")), "unknown element "), told(F.filter("once", lambda n: count(n) > 1), "repeats "),
        told(F.transform(F.filter("choices", lambda c: ~F.arrays_overlap(c, "children")), lambda c: F.array_join(c, "|")), "lacks one of "), told(F.array_except("must", names), "lacks attribute "), told(F.array_except(names, F.map_keys("kinds")), "unknown attribute "),
        told(value, "attribute "), F.when(F.array_sort(places) != places, F.array(F.lit("out of order"))).otherwise(F.array().cast("array<string>")))
    none = F.array().cast("array<string>")
    first = F.when(F.col("path").isNull(), F.array(F.lit("not well-formed"))).when(F.col("type").isNull(), F.array(F.lit("unknown element")))
    every = F.coalesce(first, F.concat(F.when(within, structure).otherwise(none), F.coalesce(wrong, none)))
    return j.select("id", "path", F.explode(every).alias("problem"))
