import random

import pytest
from landed import put, response, rows
from pyspark.sql import functions as F

from landfall.functions.names import file_name
from landfall.plans.loads import PAYLOAD, ROW_TAG
from landfall.samples import queries as sample_queries
from landfall.sources import xml_exact
from landfall.sources.csv import read_csv
from landfall.sources.listing import list_files
from landfall.sources.xml import read_xml

SCHEMA = "p string, _corrupt_record string"


def values(spark, folder, splittable, tag="R"):
    return rows(read_xml(spark, folder, tag, SCHEMA, splittable=splittable), "p")


@pytest.mark.parametrize("splittable", [False, True])
def test_elements_of_every_kind(spark, folder, splittable):
    put(folder, "a.xml", "<e><R><p>1</p></R>\n<R/><R a='1'/><R a='2'><p t='x'>2 &amp; 3</p></R><Rx><p>no</p></Rx></e>")
    put(folder, "b.xml", "<e><R></R><R><p></p></R><R><p><![CDATA[<z>]]></p></R><R><p>a</p><q>b</q></R></e>")
    put(folder, "c.xml", "<e><R><p>8</p></R ><R><p>9</p></R></e>")
    put(folder, "d.xml", "<e></e>")
    put(folder, "e.xml", "")
    want = ["1", None, None, "2 & 3", None, "", "<z>", "a", "8", "9"]
    ordered = sorted(((v,) for v in want), key=lambda t: (t[0] is not None, str(t[0])))
    assert values(spark, folder, splittable) == ordered


def test_broken_document(spark, folder):
    put(folder, "a.xml", "<e><R><p>1</p></R><R><p>2</q></R><R><p>3</p></R><R><p>4")
    assert values(spark, folder, False) == [(None,), ("1",)]
    split = read_xml(spark, folder, "R", SCHEMA, splittable=True)
    assert rows(split.where("_corrupt_record is null"), "p") == [("1",), ("3",)]
    assert rows(split, "_corrupt_record")[-2:] == [("<R><p>2</q></R>",), ("<R><p>4</R>",)]


def test_namespaced_tag_and_attributes(spark, folder):
    put(folder, "a.xml", response('[{"t10_id":"1"}]', None))
    for splittable in (False, True):
        got = read_xml(spark, folder, ROW_TAG, f"{PAYLOAD} string", splittable=splittable)
        assert rows(got, PAYLOAD) == [(None,), ('[{"t10_id":"1"}]',)]
    same = read_xml(spark, folder, "listaCargasResponse", f"{PAYLOAD} string", ignoreNamespace="true")
    assert rows(same, PAYLOAD) == [(None,), ('[{"t10_id":"1"}]',)]


def test_attributes_kept_on_request(spark, folder):
    put(folder, "a.xml", response("[]"))
    plain = read_xml(spark, folder, ROW_TAG, lineage=False)
    assert dict(plain.dtypes)[PAYLOAD] == "string"
    kept = read_xml(spark, folder, ROW_TAG, exclude_attributes=False, lineage=False)
    assert dict(kept.dtypes)[PAYLOAD].startswith("struct<_VALUE:string")


def test_inference_and_its_absence(spark, folder):
    put(folder, "a.xml", "<e><R><p>1</p><q>x</q></R></e>")
    assert dict(read_xml(spark, folder, "R", lineage=False).dtypes) == {"p": "bigint", "q": "string"}
    with pytest.raises(ValueError):
        read_xml(spark, folder, "R", splittable=True)


@pytest.mark.parametrize("splittable", [False, True])
def test_no_match_and_no_files(spark, folder, splittable):
    assert values(spark, folder, splittable) == []
    put(folder, "a.xml", "<e><S><p>1</p></S></e>")
    assert values(spark, folder, splittable) == []


EXACT_CASES = {
    "comment": "<e><!-- <R><p>no</p></R> --><R><p>1</p><!-- </R> <R> --></R><!--<R>--><R><p>2</p></R></e>",
    "cdata": "<e><R><p><![CDATA[</R><R><p>x</p>]]></p></R><x><![CDATA[<R><p>no</p></R>]]></x><R><p>3</p></R></e>",
    "attribute": "<e><R a='1>2' b=\"x/>\"><p c='>'>4</p></R><R a='/>'/><R a=\"'>\" ><p>5</p></R></e>",
    "nested": "<e><R><p>6</p><q><R><p>in</p></R></q></R><R><R/><p>7</p></R><R><R><R><p>deep</p></R></R><p>8</p></R></e>",
    "instruction": "<?xml version='1.0'?><e><?pi <R><p>no</p></R> ?><R><p>9</p></R></e>",
    "spaces": "<e><R\n><p>10</p></R\t><R ></R ><Rx><p>no</p></Rx><R.x/><R-y><p>no</p></R-y></e>",
    "root": "<R><p>11</p></R>",
    "root_line": "<R><p>12</p></R>\n",
    "doctype": "<!DOCTYPE e [ <!ENTITY z '<R><p>no</p></R>'> <!-- ' --> ]><e><R><p>13</p></R></e>",
    "empty": "",
    "none": "<e/>",
}


def small_splits(spark, size):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    return old


@pytest.mark.parametrize("size", [24, 100_000])
def test_exact_split_scan_tells_elements_apart(spark, folder, size):
    for name, text in EXACT_CASES.items():
        if name != "doctype" or size > 1000:
            put(folder, f"{name}.xml", text)
    whole = values(spark, folder, False)
    old = small_splits(spark, size)
    try:
        assert rows(read_xml(spark, folder, "R", SCHEMA, splittable="exact"), "p") == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_exact_split_scan_refuses_a_document_type_across_splits(spark, folder):
    put(folder, "a.xml", EXACT_CASES["doctype"])
    old = small_splits(spark, 16)
    try:
        with pytest.raises(ValueError, match="document type"):
            read_xml(spark, folder, "R", SCHEMA, splittable="exact")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def mixed_document(rnd):
    """A well-formed document in which everything that looks like a row element without being one occurs."""

    def inner(depth):
        kinds = ["x", "<p>{}</p>", "<!-- </R> <R> -->", "<![CDATA[</R><R>]]>", "<?do </R>?>", "<q a='>'>{}</q>", "<Rx/>", "é"]
        text = "".join(rnd.choice(kinds).format(rnd.randrange(99)) for _ in range(rnd.randrange(4)))
        return text + (element(depth + 1) + inner(depth + 1) if depth < 3 and rnd.random() < 0.3 else "")

    def element(depth=0):
        return rnd.choice(["<R/>", f"<R>{inner(depth)}</R>", f"<R a='>' b=\"</ R>\">{inner(depth)}</R >".replace("</ R>", "/>")])

    between = ["", "\n", "<!-- <R> -->", "<y><![CDATA[<R></R>]]></y>", "<?x <R>?>", "<Rest/>"]
    body = "".join(element() + rnd.choice(between) for _ in range(rnd.randrange(40)))
    return f"<?xml version='1.0' encoding='UTF-8'?>\n<e>{body}</e>"


@pytest.mark.parametrize("seed", range(3))
def test_exact_split_scan_of_random_documents(spark, folder, seed, monkeypatch):
    rnd = random.Random(seed)
    for n in range(5):
        put(folder, f"a_b_c_{n}.xml", mixed_document(rnd))
    schema = "p array<string>, q array<string>, Rx string, _corrupt_record string"
    whole = read_xml(spark, folder, "R", schema, lineage=False)
    old = small_splits(spark, (60, 150, 300)[seed])
    try:
        if seed == 2:  # as for more splits than may be broadcast
            monkeypatch.setattr(xml_exact.exact_elements, "__defaults__", (0,))
        split = read_xml(spark, folder, "R", schema, splittable="exact", lineage=False)
        assert whole.count() > 20
        assert rows(split) == rows(whole)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_exact_split_scan_of_broken_documents(spark, folder):
    put(folder, "a.xml", "<e><R><p>1</p></R><R><p>2</q></R></R><R><p>3</p></R><R><p>4</p>")
    put(folder, "b.xml", "<e><R><p>5</p></R><!-- <R><p>6</p></R>")
    found = read_xml(spark, folder, "R", SCHEMA, splittable="exact")
    assert rows(found.where("_corrupt_record is null"), "p") == [("1",), ("3",), ("5",)]
    assert rows(found.where("_corrupt_record is not null"), "_corrupt_record") == [("<R><p>2</q></R>",), ("<R><p>4</p>",)]


def test_exact_split_scan_reads_declared_encodings(spark, folder):
    with open(f"{folder}/l.xml", "wb") as out:
        out.write("<?xml version='1.0' encoding='ISO-8859-1'?><e><R><p>é ü</p></R></e>".encode("latin-1"))
    assert values(spark, folder, "exact") == values(spark, folder, False) == [("é ü",)]
    with open(f"{folder}/u.xml", "wb") as out:
        out.write("<?xml version='1.0' encoding='UTF-16'?><e><R><p>x</p></R></e>".encode("utf-16"))
    with pytest.raises(ValueError, match="u.xml"):
        values(spark, folder, "exact")


def test_exact_split_scan_refuses_streams_and_open_schemas(spark, folder):
    with pytest.raises(ValueError):
        read_xml(spark, folder, "R", splittable="exact")
    with pytest.raises(ValueError):
        read_xml(spark, folder, "R", SCHEMA, splittable="exact", stream=True)


def test_missing_folder_raises(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_xml(spark, f"{folder}/none", "R", SCHEMA)


def random_document(rnd):
    def child(name):
        texts = ["", "1", "a &amp; b", "é ü", "&lt;R&gt;", "<![CDATA[<x>]]>", "two\nlines", "w" * rnd.randrange(200)]
        text = rnd.choice(texts)
        return f"<{name}>{text}</{name}>"

    def element():
        attribute = rnd.choice(["", "", " a='1'", ' b="x/y"', "\n c='2'"])
        kind = rnd.random()
        if kind < 0.15:
            return f"<R{attribute}/>"
        if kind < 0.25:
            return f"<Rx{attribute}><p>not a row</p></Rx>"
        names = [n for n in ("p", "q", "Rname", "other") if rnd.random() < 0.6]
        return f"<R{attribute}>{''.join(child(n) for n in names)}</R>"

    gap = rnd.choice(["", "\n", "  \n\t"])
    head = rnd.choice(["", '<?xml version="1.0" encoding="UTF-8"?>\n'])
    return f"{head}<e x='1'>{gap}{gap.join(element() for _ in range(rnd.randrange(0, 60)))}{gap}</e>\n"


@pytest.mark.parametrize("seed", range(4))
def test_both_scans_agree_on_random_documents(spark, folder, seed):
    rnd = random.Random(seed)
    for n in range(12):
        put(folder, f"a_b_c_{n}.xml", random_document(rnd))
    schema = "p string, q string, Rname string, _corrupt_record string"
    whole = read_xml(spark, folder, "R", schema)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(rnd.randrange(64, 2048)))
    try:
        split = read_xml(spark, folder, "R", schema, splittable=True)
        assert whole.count() > 0
        assert split.exceptAll(whole).collect() == []
        assert whole.exceptAll(split).collect() == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_one_large_file_is_spread_over_tasks(spark, folder):
    body = "\n".join(f'<ns1:R x="{i}"><p>value é {i}</p><q>{"y" * (i % 50)}</q></ns1:R>' for i in range(5000))
    put(folder, "a.xml", f'<e xmlns:ns1="u">{body}</e>')
    whole = read_xml(spark, folder, "ns1:R", SCHEMA)
    assert whole.rdd.getNumPartitions() == 1
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        split = read_xml(spark, folder, "ns1:R", SCHEMA, splittable=True)
        assert split.rdd.getNumPartitions() > 10
        assert split.exceptAll(whole).count() == 0
        assert whole.exceptAll(split).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("splittable", [False, True])
def test_lineage(spark, folder, splittable):
    put(folder, "a b_c+d.xml", "<e><R><p>1</p></R></e>")
    got = read_xml(spark, folder, "R", SCHEMA, splittable=splittable)
    path = got.select("SourceFileName").first()[0]
    assert path.endswith("/a%20b_c+d.xml")
    assert rows(got.select(file_name("SourceFileName"))) == [("a b_c+d.xml",)]
    # The same file as the reader's own function names it, but for the slashes after "file:".
    other = spark.read.format("xml").schema("p string").option("rowTag", "R").load(folder)
    assert other.select(F.input_file_name()).first()[0].replace("file:///", "file:/") == path
    assert rows(list_files(spark, folder), "SourceFileName") == [(path,)]


def test_listing_is_fixed_when_made(spark, folder):
    put(folder, "a.xml", "12345")
    listing = list_files(spark, folder)
    put(folder, "b.xml", "1")
    assert rows(listing, "bytes") == [(5,)]


def test_csv_parts_with_headers(spark, folder):
    put(folder, "part-00000.csv", "port,depth\nÅlesund,12\n")
    put(folder, "part-00001.csv", "port,depth\nGdynia,14\nKočevje,0\n")
    assert rows(read_csv(spark, folder, "port string, depth int")) == [("Gdynia", 14), ("Kočevje", 0), ("Ålesund", 12)]


def test_fragments_in_a_row_read_as_one_by_one():
    lexer = xml_exact.Lexer("R")
    odd = ["<R a='</R><R>", '<R a="x', "<!-- </R>", "-->", "<![CDATA[</R>", "]]>", "<?x </R> ?>", '<!DOCTYPE e SYSTEM "</R>">', "</R>", "<R/>", "<R>", "'", '"']
    rnd = random.Random(4)
    for _ in range(300):
        data = ("".join(rnd.choices(odd, k=12)) + "</R>").encode()
        parts = [p + b"</R>" for p in data.split(b"</R>")[:-1]]
        whole = xml_exact.Map.of(lexer, data, xml_exact.TEXT)
        single = xml_exact.Map(xml_exact.TEXT)
        for part in parts:
            single.then(xml_exact.Map.of(lexer, part, single.state))
        assert vars(whole) == vars(single)


def test_exact_scan_query_lands_by_all_tasks(spark, folder, monkeypatch):
    rows = spark.range(40).selectExpr("id as l_orderkey", "cast(id % 7 as int) as l_linenumber", "'A' as l_returnflag", "id as l_partkey")
    rows.repartition(4).write.parquet(f"{folder}/lineitem.parquet")
    tasks = []
    put_elements = sample_queries.write_elements
    monkeypatch.setattr(sample_queries, "write_elements", lambda e, *a: tasks.append(e.rdd.getNumPartitions()) or put_elements(e, *a))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "134217728")
    try:
        assert sample_queries.xml_exact_split_scan(spark, folder).count() == 40
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert tasks == [4]
