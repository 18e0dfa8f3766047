import json

import pytest

from terrace.sources import files


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        store = files.SchemaStore(spark, f"file://{tmp_path}/schema.json")
        opened: list = []

        def put(self, name, text):
            (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / "in" / name).write_text(text)

        def run(self, kind, make=lambda raw: raw, **more):
            def seen(raw):
                self.opened = sorted(x.rsplit("/", 1)[-1] for x in raw.inputFiles())
                return make(raw)

            self.opened = []
            files.ingest(spark, str(tmp_path / "in"), kind, self.store, seen, f"{tmp_path}/out", f"{tmp_path}/checkpoint", **more)

        def rows(self, *names):
            df = spark.read.option("mergeSchema", True).parquet(f"{tmp_path}/out")
            return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)

    return Place()


def test_csv_columns_by_name(place):
    place.put("a.csv", "customer_id,name,email\n1,Ann,ann@x.org\n")
    place.put("b.csv", "customer_id,email,name,phone\n2,bob@x.org,Bob,090-1\n")
    place.run("csv")
    assert place.rows("customer_id", "name", "email", "phone") == [("1", "Ann", "ann@x.org", None), ("2", "Bob", "bob@x.org", "090-1")]
    assert sorted(place.store.load().names) == ["customer_id", "email", "name", "phone"]
    place.put("more/c.csv", "PHONE,customer_id,note\n090-3,3,n\n")
    place.run("csv")
    assert place.opened == ["c.csv"]
    assert place.rows("customer_id", "phone", "note", "_rescued_data")[-1] == ("3", "090-3", "n", None)
    place.run("csv")
    assert place.opened == []
    assert len(place.rows("customer_id")) == 3


def test_csv_records_that_do_not_fit(place):
    place.put("a.csv", '﻿id,x,x,\n1,"a, b",c,d\n2,only\n3,p,q,r,surplus\n')
    place.put("empty.csv", "")
    place.put("head.csv", "id,x\n")
    place.run("csv")
    got = {r[0]: r[1:] for r in place.rows("id", "x", "x_c2", "_c3", "_rescued_data")}
    assert got["1"] == ("a, b", "c", "d", None)
    assert got["2"][:3] == ("only", None, None)
    assert json.loads(got["3"][3]) == {"_record": "3,p,q,r,surplus"}


def test_csv_without_evolution_rescues(place):
    place.put("a.csv", "id,x\n1,a\n")
    place.run("csv", evolve=False)
    place.put("b.csv", "new,id\nn,2\n")
    place.run("csv", evolve=False)
    assert place.store.load().names == ["id", "x"]
    assert place.rows("id", "x", "_rescued_data") == [("1", "a", None), ("2", None, '{"new":"n"}')]


def test_json_types_and_new_columns(place):
    place.put("a.json", '{"id": 1, "amount": 2.5, "at": {"x": 1}, "n": 7}\n\nbroken{\n[1]\n')
    place.run("json")
    place.put("b.json", '{"id": 2, "amount": "many", "at": 3, "n": 1.5, "late": true}\n{"id": 3, "amount": 4, "ID": "other", "n": null}\n')
    place.run("json")
    assert place.opened == ["b.json"]
    got = {r[0]: r[1:] for r in place.rows("id", "amount", "n", "late", "_rescued_data") if r[0]}
    assert got[1] == (2.5, 7, None, None)
    assert got[2][:3] == (None, None, True)
    assert json.loads(got[2][3]) == {"amount": "many", "at": "3", "n": "1.5"}
    assert got[3][:2] == (4.0, None)
    assert json.loads(got[3][3]) == {"ID": "other"}
    broken = [json.loads(r[1]) for r in place.rows("id", "_rescued_data") if r[0] is None]
    assert broken == [{"_record": "[1]"}, {"_record": "broken{"}]


def test_json_without_evolution_rescues(place):
    place.put("a.json", '{"id": 1}\n')
    place.run("json", evolve=False)
    place.put("b.json", '{"id": 2, "x": {"y": 1}}\n')
    place.run("json", evolve=False)
    assert place.rows("id", "_rescued_data") == [(1, None), (2, '{"x":"{\\"y\\":1}"}')]


def test_no_card_number_is_rescued(place):
    place.put("a.json", '{"order_id": "1", "payment_card_number": 4111111111111111}\n')
    place.put("b.json", "not json 4111-1111-1111-1234\n")
    place.run("json", lambda raw: files.bronze_orders(raw, "s"))
    place.put("c.json", '{"order_id": "2", "payment_card_number": "4111 1111 1111 9876"}\n')
    place.run("json", lambda raw: files.bronze_orders(raw, "s"))
    got = place.rows("order_id", "payment_card_last4", "_rescued_data")
    assert sorted(got, key=repr) == sorted([("1", "1111", None), ("2", "9876", None), (None, None, '{"_record":"not json ****"}')], key=repr)


@pytest.mark.parametrize("alone", [True, False])
def test_many_files_in_one_run(place, monkeypatch, alone):
    """Also where the session puts several files into one task; blank lines come before some headers."""
    if not alone:
        monkeypatch.setattr(files, "ALONE", {})
    for i in range(30):
        place.put(f"{i}.csv", "\n" * (i % 3 == 0) + ("a,b\n" if i % 2 else "b,a\n") + "".join(f"{i},{k}\n" for k in range(40)))
    place.run("csv")
    got = place.rows("a", "b")
    assert len(got) == 1200
    assert {(int(a), int(b)) for a, b in got} == {(i, k) if i % 2 else (k, i) for i in range(30) for k in range(40)}
