"""Documents against a schema: sound ones pass, each planted fault is told, and the library's own documents hold."""

import pytest
from pyspark.sql import functions as F

from castellan.operators import schema as sc
from castellan.operators.documents import tournament_documents
from castellan.sources.registry import CROSSTABLE

CORE = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" xmlns:t="urn:t"><xs:include schemaLocation="types.xsd"/>
<xs:element name="open" type="t:OpenType"/><xs:element name="note"><xs:complexType><xs:simpleContent><xs:extension base="xs:string"><xs:attribute name="lang" type="xs:language"/></xs:extension></xs:simpleContent></xs:complexType></xs:element>
<xs:complexType name="OpenType"><xs:sequence><xs:element name="name" type="xs:string"/><xs:element name="when" type="t:When"/><xs:element name="rating" type="t:Rating" minOccurs="0"/>
<xs:element name="game" minOccurs="0" maxOccurs="unbounded"><xs:complexType><xs:attribute name="eco" type="t:Eco"/><xs:attribute name="white" type="xs:IDREF" use="required"/></xs:complexType></xs:element><xs:element ref="t:note" minOccurs="0"/></xs:sequence><xs:attribute name="id" type="xs:ID" use="required"/></xs:complexType>
</xs:schema>"""
TYPES = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" xmlns:t="urn:t">
<xs:simpleType name="Rating"><xs:restriction base="xs:integer"><xs:minInclusive value="0"/><xs:maxInclusive value="4000"/></xs:restriction></xs:simpleType>
<xs:simpleType name="Eco"><xs:restriction base="xs:token"><xs:pattern value="[A-E][0-9]{2}"/></xs:restriction></xs:simpleType>
<xs:simpleType name="Kind"><xs:restriction base="xs:token"><xs:enumeration value="swiss"/><xs:enumeration value="team"/></xs:restriction></xs:simpleType>
<xs:complexType name="When"><xs:choice><xs:element name="year" type="xs:gYear"/><xs:sequence><xs:element name="day" type="xs:date"/><xs:element name="kind" type="t:Kind" minOccurs="0"/></xs:sequence></xs:choice></xs:complexType>
</xs:schema>"""
SOUND = '<open xmlns="urn:t" id="a1"><name>x</name><when><day>1994-05-01</day><kind> swiss </kind></when><rating>2400</rating><game eco="C42" white="p1"/><game white="p2"/><note lang="en-GB">free</note></open>'


@pytest.fixture(scope="module")
def schema(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("xsd")
    (d / "core.xsd").write_text(CORE)
    (d / "types.xsd").write_text(TYPES)
    return sc.read_schema(spark, f"file://{d}/core.xsd")


def problems(spark, schema, *xml):
    d = spark.createDataFrame([(i, x) for i, x in enumerate(xml)], "id int, xml string")
    return sorted((r.id, r.path, r.problem) for r in sc.document_problems(d, schema).collect())


def test_each_fault_is_told(spark, schema):
    faults = {
        SOUND: [], SOUND.replace("2400", "4001"): [("/open/rating", "no Rating: 4001")], SOUND.replace("2400", "24x"): [("/open/rating", "no Rating: 24x")], SOUND.replace("C42", "F42"): [("/open/game", "attribute eco is no Eco: F42")],
        SOUND.replace(' white="p1"', ""): [("/open/game", "lacks attribute white")], SOUND.replace(' white="p2"', ' white="p2" black="p"'): [("/open/game", "unknown attribute black")], SOUND.replace(" swiss ", "Swiss"): [("/open/when/kind", "no Kind: Swiss")],
        SOUND.replace("<name>x</name>", ""): [("/open", "lacks name")], SOUND.replace("<rating>", "<elo/><rating>"): [("/open", "unknown element elo")], SOUND.replace("<rating>2400</rating>", "<rating>1</rating><rating>2</rating>"): [("/open", "repeats rating")],
        SOUND.replace("<day>1994-05-01</day><kind> swiss </kind>", ""): [("/open/when", "lacks one of year|day|kind")], SOUND.replace('<name>x</name>', "").replace("<rating>", "<name>x</name><rating>"): [("/open", "out of order")], SOUND.replace('id="a1"', 'id="1a"'): [("/open", "attribute id is no ID: 1a")],
        SOUND.replace("en-GB", "e n"): [("/open/note", "attribute lang is no language: e n")], "<open": [(None, "not well-formed")], "<other/>": [("/other", "unknown element")], SOUND.replace("1994-05-01", "May"): [("/open/when/day", "no date: May")],
    }
    got = problems(spark, schema, *faults)
    assert got == sorted(((i, *f) for i, fs in enumerate(faults.values()) for f in fs), key=lambda x: (x[0], x[1] or "", x[2]))


OWN = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="tournament"><xs:complexType><xs:sequence>
<xs:element name="header"><xs:complexType><xs:sequence><xs:element name="name" type="xs:string"/><xs:element name="eventType" type="Format" minOccurs="0"/><xs:element name="dates"><xs:complexType><xs:sequence><xs:element name="start" type="Date"/><xs:element name="end" type="Date"/></xs:sequence></xs:complexType></xs:element></xs:sequence></xs:complexType></xs:element>
<xs:element name="participants"><xs:complexType><xs:sequence><xs:element name="participant" maxOccurs="unbounded"><xs:complexType><xs:sequence><xs:element name="playerRef" type="Player"/><xs:element name="seed" type="xs:positiveInteger" minOccurs="0"/><xs:element name="score" type="xs:decimal" minOccurs="0"/></xs:sequence><xs:attribute name="id" type="xs:ID" use="required"/></xs:complexType></xs:element></xs:sequence></xs:complexType></xs:element>
<xs:element name="source"><xs:complexType><xs:sequence><xs:element name="note" type="xs:string"/></xs:sequence><xs:attribute name="kind" type="xs:token" use="required"/></xs:complexType></xs:element></xs:sequence><xs:attribute name="ctmlVersion" type="xs:token" use="required"/><xs:attribute name="id" type="xs:ID" use="required"/></xs:complexType></xs:element>
<xs:simpleType name="Format"><xs:restriction base="xs:token"><xs:enumeration value="swiss"/></xs:restriction></xs:simpleType>
<xs:complexType name="Date"><xs:choice><xs:element name="day"><xs:complexType><xs:attribute name="y" type="xs:integer" use="required"/><xs:attribute name="m" type="Month" use="required"/><xs:attribute name="d" type="xs:integer" use="required"/><xs:attribute name="iso" type="xs:date"/></xs:complexType></xs:element></xs:choice></xs:complexType>
<xs:simpleType name="Month"><xs:restriction base="xs:integer"><xs:minInclusive value="1"/><xs:maxInclusive value="12"/></xs:restriction></xs:simpleType>
<xs:complexType name="Player"><xs:sequence><xs:element name="name"><xs:complexType><xs:sequence><xs:element name="family" type="xs:string"/><xs:element name="given" type="xs:string" minOccurs="0" maxOccurs="unbounded"/></xs:sequence><xs:attribute name="display" type="xs:string" use="required"/></xs:complexType></xs:element><xs:element name="resolution" minOccurs="0"><xs:complexType><xs:attribute name="method" type="xs:token"/><xs:attribute name="resolver" type="xs:token"/></xs:complexType></xs:element></xs:sequence><xs:attribute name="ref" type="xs:token" use="required"/></xs:complexType>
</xs:schema>"""


def test_own_documents(spark, tmp_path):
    (tmp_path / "own.xsd").write_text(OWN)
    own = sc.read_schema(spark, f"file://{tmp_path}/own.xsd")
    table = '{"event": "Open %d", "format": "Swiss", "source": "src", "ref": "r", "start": "2003-02-0%d", "players": [{"name": "Doe, John", "score": %s}]}'
    d = spark.createDataFrame([(i, table % (i, i, s)) for i, s in ((1, 2.5), (2, 3))], "ord int, j string").select("ord", F.from_json("j", CROSSTABLE).alias("t")).select("ord", "t.*")
    docs = tournament_documents(d).select("id", "xml")
    assert sc.document_problems(docs, own).collect() == []
    planted = docs.withColumn("xml", F.replace(F.replace("xml", F.lit('m="2"'), F.lit('m="13"')), F.lit("swiss"), F.lit("cup")))
    assert {r.problem for r in sc.document_problems(planted, own).collect()} == {"no Format: cup", "attribute m is no Month: 13"}
