from pyspark.sql import functions as F

from shelfspark.operators import clean
from shelfspark.schema import IMPORT_COLUMNS


def feed(spark, rows):
    full = [tuple([i + 2] + [row.get(c, "") for c in IMPORT_COLUMNS]) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, "row_number bigint, " + ", ".join(f"`{c}` string" for c in IMPORT_COLUMNS))


def cleaned(spark, rows):
    return clean.clean_catalog(feed(spark, rows)).orderBy("row_number").collect()


def test_messy_row(spark):
    row = cleaned(spark, [{
        "Item ID": "36003522/05X", "Order by": "invalid", "Price": "CHF 24,95/Box", "Status": "wrong", "VAT": "40.05",
        "Labels": "BIO,foo,DISCOUNTED", "Item name": "Becher 8 x 250 Stück / Karton", "Description": "8 x 250 Stück / Karton",
        "Vessel type": "cup", "Bundle type": "Karton"}])[0]
    expected = {"Item ID": "36003522-05X", "Order by": "vessel", "Price": "24.95", "Status": "ACTIVE", "VAT": "",
                "Labels": "BIO,DISCOUNTED", "Bundle size": "2000", "Bundle type": "CT", "Vessel size": "1",
                "Vessel unit": "quantity", "Vessel type": "CU", "Price per": "vessel", "Category name": "Uncategorized"}
    assert {k: row[k] for k in expected} == expected


def test_duplicate_ids_get_the_row_number(spark):
    rows = cleaned(spark, [{"Item ID": "AW402-07/8"}, {"Item ID": "AW402-07\\8"}])
    assert [r["Item ID"] for r in rows] == ["AW402-07-8", "AW402-07-8-row00003"]


def test_lookalike_of_a_suffixed_id(spark):
    rows = cleaned(spark, [{"Item ID": i} for i in ["X", "X", "X-row00003", "X-row00003-row00004", "", "null"]])
    assert [r["Item ID"] for r in rows] == [
        "X", "X-row00003", "X-row00003-row00004", "X-row00003-row00004-row00005", "row00006", ""]


def test_ids_against_a_plain_loop(spark):
    raw = ["a", "b", "a", "a-row00004", "b", "a", "c/d", "c d", "c-d", "a-row00004-row00005"] * 3
    taken, expected = set(), []
    for n, value in enumerate(raw, start=2):
        current = value.replace("/", "-").replace(" ", "-")
        if current in taken:
            current = f"{current}-row{n:05d}"
        taken.add(current)
        expected.append(current)
    assert [r["Item ID"] for r in cleaned(spark, [{"Item ID": i} for i in raw])] == expected


def test_fractional_sizes(spark):
    litre = cleaned(spark, [{"Item ID": "1", "Vessel size": "0.45", "Vessel unit": "l", "Bundle size": "0.45", "Bundle type": "PK"}])[0]
    assert (litre["Vessel size"], litre["Bundle size"], litre["Bundle type"]) == ("0.45", "", "")
    gram = cleaned(spark, [{"Item ID": "1", "Vessel size": "16.6", "Vessel unit": "g", "Bundle size": "24", "Bundle type": "PK"}])[0]
    assert [gram[c] for c in ("Vessel size", "Vessel unit", "Bundle size", "Bundle type")] == ["1", "quantity", "24", "PK"]


def test_corrections_replay_to_the_cleaned_row(spark, sf_dir):
    from shelfspark.plans.derived import view
    rows = view(spark, sf_dir, "feed")
    result = {r["row_number"]: r.asDict() for r in clean.clean_catalog(rows).collect()}
    start = {r["row_number"]: r.asDict() for r in rows.collect()}
    finals = {}
    for c in clean.clean_corrections(rows).collect():
        finals.setdefault((int(c["row_number"]), c["field"]), []).append((c["value_before"], c["value_after"]))
    for n, row in result.items():
        for field in IMPORT_COLUMNS:
            moves = finals.get((n, field), [])
            if not moves:
                assert start[n][field] == row[field], (n, field)
            else:
                assert row[field] in {after for _, after in moves}, (n, field)


def test_cleaning_is_stable(spark, sf_dir):
    from shelfspark.plans.derived import view
    once = clean.clean_catalog(view(spark, sf_dir, "feed"))
    rows = once.filter(F.col("Item ID") != "").collect()
    twice = clean.clean_catalog(spark.createDataFrame(rows, once.schema)).collect()
    price = {r["row_number"]: (r["Price"], r["GTIN"], r["Vessel unit"]) for r in rows}
    assert {r["row_number"]: (r["Price"], r["GTIN"], r["Vessel unit"]) for r in twice} == price


def test_ids_built_on_suffixed_ids_of_any_depth(spark):
    raw = ["X", "X"]
    for number in range(3, 8):  # each looks like the name the row before has just been given
        raw.append(raw[-1] + f"-row{number:05d}")
    taken, expected = set(), []
    for number, name in enumerate(raw, 2):
        name = f"{name}-row{number:05d}" if name in taken else name
        taken.add(name)
        expected.append(name)
    got = [r["Item ID"] for r in cleaned(spark, [{"Item ID": i} for i in raw])]
    assert got == expected and len(set(got)) == len(got)


def test_both_outputs_equal_the_single_ones(spark):
    rows = feed(spark, [{"Item ID": "A/1", "Price": "CHF 2,50", "Status": "x"}, {"Item ID": "A/1", "Price": "3", "Status": "ACTIVE"}])
    table, corrections = clean.clean_both(rows)
    assert sorted(table.collect()) == sorted(clean.clean_catalog(rows).collect())
    assert sorted(map(str, corrections.collect())) == sorted(map(str, clean.clean_corrections(rows).collect()))


def test_shared_texts_are_read_once_each(spark, monkeypatch):
    """Rows that share texts give what rows that read their own texts give, and the texts are scanned below a lookup."""
    texts = ["6 x 0,75 l Flasche", "8 x 250 Stk", "24 Stk / Karton", "", "1,5 kg", "3 x 16.6 g", "12 Pieces/Box 2 x 5 Stück"]
    rows = [{"Item ID": f"i{n % 31}", "Item name": texts[n % 7], "Material": texts[n % 2], "Vessel unit": ["", "ml"][n % 2], "Price": str(n)} for n in range(140)]
    shared = clean.clean_catalog(feed(spark, rows))
    read_once = [r.asDict() for r in shared.orderBy("row_number").collect()]
    assert "regexp_extract(evidence" not in shared._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(clean, "SHARED_BY", 1000)
    assert read_once == [r.asDict() for r in clean.clean_catalog(feed(spark, rows)).orderBy("row_number").collect()]


def test_ids_take_one_pass(spark):
    rows = spark.createDataFrame([(" a//b \\ c ",), ("-x--y-",), ("ü (neu)",), ("\xa0/\xa0",), (None,)], "id string")
    made = rows.select(clean.sanitize_id(F.col("id")).alias("id"))
    assert [r["id"] for r in made.collect()] == ["a-b-c", "-x-y-", "-neu-", "-", ""]
    assert made._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
