import json

import pytest

from wareloom.operators.flatten import explode_list, flatten_listings, join_text_lists
from wareloom.sources import listings as S
from wareloom.sources.listings import as_frame, read_listings


def listing(**fields):
    return {"id": "L1", "condition": "new", **fields}


def attribute(name):
    return {"id": name, "name": name, "attribute_group_id": "G", "attribute_group_name": "Group",
            "value_id": None, "value_name": None}


def test_two_lists_multiply_and_empty_lists_keep_the_row(spark):
    docs = as_frame(
        spark,
        [
            listing(attributes=[attribute("A"), attribute("B")],
                    pictures=[{"id": "p", "url": "u", "size": "s"}, {"id": "q", "url": "u", "size": "s"}],
                    variations=[], non_mercado_pago_payment_methods=None),
            {"id": "L2", "attributes": None, "pictures": [], "seller_address": None},
        ],
    )
    flat = flatten_listings(docs)
    rows = [(r.product_id, r.attr_id, r.pic_id) for r in flat.collect()]
    assert sorted(rows, key=str) == sorted(
        [("L1", "A", "p"), ("L1", "A", "q"), ("L1", "B", "p"), ("L1", "B", "q"), ("L2", None, None)], key=str
    )
    assert "id" in flat.columns and "rule_value" in flat.columns and "var_comb_id" in flat.columns


@pytest.mark.parametrize("sizes", [(0, 0, 0), (1, 2, 3), (3, 0, 2), (2, 2, 2)])
def test_rows_are_the_product_of_the_sizes(spark, sizes):
    n_attr, n_pic, n_pay = sizes
    docs = as_frame(
        spark,
        [listing(attributes=[attribute(str(i)) for i in range(n_attr)],
                 pictures=[{"id": str(i), "url": "", "size": ""} for i in range(n_pic)],
                 non_mercado_pago_payment_methods=[{"id": str(i), "description": "", "type": ""} for i in range(n_pay)])],
    )
    expected = max(1, n_attr) * max(1, n_pic) * max(1, n_pay)
    assert flatten_listings(docs).count() == expected


def test_nested_places_and_free_methods(spark):
    docs = as_frame(
        spark,
        [listing(seller_address={"country": {"id": "1", "name": "X"}, "state": {"id": "2", "name": "Y"}, "city": None},
                 shipping={"local_pick_up": True, "free_shipping": False, "mode": "me2",
                           "free_methods": [{"id": 7, "rule": {"value": None, "free_mode": "country"}}]})],
    )
    row = flatten_listings(docs).first()
    assert (row.seller_address_country, row.seller_address_state, row.seller_address_city) == ("X", "Y", None)
    assert (row.shipping_mode, row.id, row.rule_free_mode) == ("me2", 7, "country")


def test_text_lists_skip_null_elements(spark):
    df = spark.createDataFrame([(["a", None, "b"],), ([],), (None,)], "tags array<string>")
    assert [r.tags for r in join_text_lists(df, ["tags"]).collect()] == ["a,b", "", None]


def test_explode_keeps_column_order(spark):
    df = spark.createDataFrame([(1, [2, 3], 4)], "a int, b array<int>, c int")
    assert explode_list(df, "b").columns == ["a", "b", "c"]


def test_malformed_line_fails(spark, tmp_path):
    path = tmp_path / "listings.jsonl"
    path.write_text(json.dumps({"id": "L1"}) + "\n{broken\n", encoding="utf-8")
    with pytest.raises(Exception):
        read_listings(spark, str(path)).collect()


def test_lines_are_written_packed_and_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "LINES_PER_FILE", 200)
    texts = [json.dumps({"id": f"L{i}", "title": f"Lot {i}", "condition": "new"}) for i in range(500)]
    lines = spark.createDataFrame([(t,) for t in texts], "line string").repartition(1)
    path = S.write_lines(lines, str(tmp_path / "lines"))
    files = list((tmp_path / "lines").glob("part-*"))
    assert len(files) == 3 and sum(f.stat().st_size for f in files) < sum(map(len, texts)) / 3
    read = read_listings(spark, path).select("id", "title", "condition").collect()
    assert sorted((r.id, r.title, r.condition) for r in read) == sorted((f"L{i}", f"Lot {i}", "new") for i in range(500))
