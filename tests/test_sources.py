import json

import pytest
from pyspark.sql import functions as F

from placeloom.sources import readers, sinks
from placeloom.streaming import notes

BOX = (0.0, 50.0, 1.0, 52.0)


def put(tmp_path, name, content):
    p = tmp_path / name
    p.write_text(content if isinstance(content, str) else json.dumps(content))
    return str(p)


def test_places(spark, tmp_path):
    row = lambda i, x, sites, src: (i, (f"n{i}",), (x, x + 0.1, 51.0, 51.1), [("f", "P1")], sites, [], [], [(s, p, 0.9) for s, p in src], 0.9, "cafe", "open")
    rows = [row("a", 0.5, ["http://a"], [("meta", "")]), row("b", 0.95, ["http://b"], [("Microsoft", "")]), row("c", 5.0, ["x"], [("meta", "")]), row("d", -0.05, [], [("Foursquare", "")])]
    spark.createDataFrame(rows, readers.PLACES).write.parquet(str(tmp_path / "p"))
    got = readers.places(spark, str(tmp_path / "p"), BOX)
    assert [(r.id, r.name, r.website, r.postcode) for r in got.collect()] == [("a", "na", "http://a", "P1")]
    assert "PushedFilters: [" in (plan := got._jdf.queryExecution().toString()) and "bbox.xmin" in plan
    assert sorted(r.id for r in readers.places(spark, str(tmp_path / "p"), BOX, "raw").collect()) == ["a", "b", "d"]
    assert [r.id for r in readers.places(spark, str(tmp_path / "p"), BOX, "licensed").collect()] == ["d"]
    assert readers.newest_release(["x/2030-01-02.0/", "2030-01-02.10", "zz"], "p") == "2030-01-02.10" and readers.newest_release([], "p") == "p"


def test_companies(spark, tmp_path):
    path = put(tmp_path, "c.csv", 'CompanyName,CompanyNumber,CompanyStatus,Post,IncorporationDate,SIC1,SIC2,Prev1\n"Cafe, The",1,Active,A1,03/02/2020,56101 - x,,Old\nShop,2,Active,,bad,47110,,\nGone,3,Dissolved,,,56101,,\n')
    names = {"name": ["CompanyName"], "number": ["CompanyNumber"], "status": ["CompanyStatus"], "postcode": ["PostCode", "Post"], "incorporated": ["IncorporationDate"], "codes": ["SIC1", "SIC2"], "previous": ["Prev1"]}
    r = readers.companies(spark, path, ["5610"], names).collect()
    assert [(x.name, str(x.incorporated), x.codes, x.previous, x.town) for x in r] == [("Cafe, The", "2020-02-03", ["56101 - x"], ["Old"], None)]
    with pytest.raises(ValueError, match="status"):
        readers.companies(spark, path, ["5"], names | {"status": ["Status"]})


def test_register_elements_features(spark, tmp_path):
    e = {"FHRSID": 5, "BusinessName": " Cafe ", "BusinessType": "Bar", "AddressLine1": "1 St", "AddressLine2": " ", "AddressLine3": "Town", "Geocode": {"Latitude": "51.5", "Longitude": "x"}}
    path = put(tmp_path, "r.json", {"FHRSEstablishment": {"Header": {}, "EstablishmentCollection": [e, e | {"FHRSID": 6, "BusinessType": "School"}]}})
    r = readers.register(spark, path, ("School",)).collect()
    assert [(x.fsa_id, x.name, x.address_lines, x.lat, x.lng) for x in r] == [(5, "Cafe", ["1 St", "Town"], 51.5, None)]
    path = put(tmp_path, "o.json", {"elements": [{"type": "node", "id": 1, "lat": 51.0, "lon": 0.5, "tags": {"name": "A"}, "version": 1}, {"type": "node", "id": 1, "lat": 51.2, "lon": 0.5, "tags": {"name": "A"}, "version": 2}, {"type": "way", "id": 2, "center": {"lat": 51.0, "lon": 0.1}, "tags": {"name": "B"}}, {"type": "node", "id": 3, "lat": 1.0, "lon": 1.0, "tags": {}}]})
    el = readers.map_elements(spark, path)
    assert sorted((x.type, x.id, x.lat) for x in el.collect()) == [("node", 1, 51.2), ("way", 2, 51.0)]
    meta = readers.object_metadata(spark, put(tmp_path, "o.opl", "n1 v7 dV c1 t2030-01-02T03:04:05Z i1 x0.5 y51\nw9 v1\n"))
    assert {x.id: (x.version, x.touched) for x in readers.with_metadata(el, meta).collect()} == {1: (7, "2030-01-02T03:04:05Z"), 2: (None, None)}
    with pytest.raises(ValueError):
        readers.with_metadata(el, meta.where("false"))
    f = {"geometry": {"type": "Point", "coordinates": [0.5, 51.0]}, "properties": {"name": "A", "brand": ""}}
    far = {"geometry": {"type": "Point", "coordinates": [9.0, 51.0]}, "properties": {}}
    got = readers.features(spark, put(tmp_path, "f.json", {"features": [f, far]}), BOX, ["name", "brand"]).collect()
    assert [(x.lat, x.name, x.brand) for x in got] == [(51.0, "A", None)]
    assert readers.features(spark, put(tmp_path, "f.jsonl", json.dumps(f) + "\n" + json.dumps(far)), BOX, ["name"], lines=True).count() == 1


def test_other_readers(spark, tmp_path):
    csv = put(tmp_path, "n.csv", "ods,name,org,address,postcode,contract,mo,tu,we,th,fr,sa,su\nX,P,,,A1,Community,09:00-17:30,closed,,,,,\nY,Q,,,A1,Distance Selling,,,,,,,\n")
    assert [(r.ods, r.hours) for r in readers.pharmacies(spark, csv).collect()] == [("X", {"Mo": "09:00-17:30"})]
    snap = put(tmp_path, "s.json", [{"storeId": 1, "name": "Espoo", "latitude": "60.1", "pos": {"lng": 24.1}}])
    got = readers.snapshot(spark, snap, "storeId int, name string, latitude string, pos struct<lng:double>", {"name": "concat('Shop ', name)", "lat": "latitude", "lng": "pos.lng"}, "chain").first()
    assert (got.src, got.name, got.lat, got.lng, got.phone) == ("chain", "Shop Espoo", 60.1, 24.1, None)
    for p in ("eu/gb/x", "Bad Name"):
        (tmp_path / "packs" / p).mkdir(parents=True)
        (tmp_path / "packs" / p / "meta.json").write_text('{"n": 1}')
    assert [(r.id, r.meta) for r in readers.packs(spark, str(tmp_path / "packs")).collect()] == [("eu/gb/x", '{"n": 1}')]
    rows = spark.createDataFrame([("A 1", None, None), ("A1", 51.0, 0.5), ("A1", 58.0, 0.5), ("Z", None, None)], "postcode string, lat double, lng double")
    cent = spark.createDataFrame([("a1", 51.01, 0.5)], "postcode string, lat double, lng double")
    assert sorted((r.lat or 0, r.geo_precision) for r in readers.filled_from_centroid(rows, cent).collect()) == [(0, "source"), (51.0, "source"), (51.01, "postcode"), (51.01, "postcode")]
    runs = spark.createDataFrame([("a", 1, "ok"), ("a", 2, "ok"), ("a", 3, "failed"), ("b", 5, "ok"), ("c", 1, "ok")], "source string, run int, status string")
    want = spark.createDataFrame([("a", "failed"), ("b", "empty"), ("c", None)], "source string, status string")
    assert {r.source: r.run for r in readers.newest_healthy(runs, want).collect()} == {"a": 2, "c": 1}
    made = []
    for since in (0, 0, 9e12):
        readers.read_or_make(spark, str(tmp_path / "made"), since, lambda: made.append(1) or spark.range(3)).count()
    assert len(made) == 2


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", "Café One", 51.5, 0.1, "gb", "x", 1), ("b", "Cafe", 60.1, 24.9, "fi", "y", 2)], "id string, name string, lat double, lng double, country string, area string, rank int")
    sinks.write_packs(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).where("country = 'fi'").count() == 1
    sinks.write_shards(sinks.detail_shards(df), str(tmp_path / "s"), "shard")
    assert len(list((tmp_path / "s").glob("shard=*/*.json.gz"))) == 2
    pin = json.loads(sinks.pins(df, ["id"]).first().feature)
    assert pin["geometry"] == {"type": "Point", "coordinates": [0.1, 51.5]} and pin["properties"] == {"id": "a"}
    index = sinks.name_shards(df, "id", "name").join(df.select("id", "rank"), "id")
    assert sorted((r.shard, r.token) for r in index.collect()) == [("caf", "cafe"), ("caf", "cafe"), ("one", "one")]
    assert [r.id for r in sinks.search_shards(index, "Cafe", "id", "name", "rank").collect()] == ["b", "a"]
    s = sinks.file_stats(df, "f", "lat", "lng").first()
    assert (s.rows, s.bounds) == (2, [0.1, 51.5, 24.9, 60.1])


def test_notes_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    line = lambda **k: json.dumps({"note_id": "1", "poi_id": "p", "author": "", "rating": "5", "text": " fine ", "date": "2030-01-01T10:00:00"} | k)
    (src / "a.json").write_text("\n".join([line(), line(), line(note_id="2", rating="9"), line(note_id="3", text=" "), line(note_id="4", author="A" * 99)]))
    run = lambda: notes.append_notes(notes.accepted(notes.read_notes(spark, str(src))), str(tmp_path / "out"), str(tmp_path / "chk")).awaitTermination()
    run()
    (src / "b.json").write_text(line() + "\n" + line(note_id="5"))
    run()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.author[:3], r.rating, r.text) for r in got.collect()) == [("AAA", 5, "fine"), ("Ano", 5, "fine"), ("Ano", 5, "fine")]
    daily = notes.daily(spark.read.schema(notes.NOTES).json(str(src)))
    assert daily.agg(F.sum("n")).first()[0] == 7


def test_features_that_are_no_points_stand_at_the_centre_of_their_box(spark, tmp_path):
    shapes = [("Polygon", "[[[0,0],[4,0],[4,2],[0,2],[0,0]]]"), ("LineString", "[[0,0],[2,6]]"), ("MultiPolygon", "[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[7,5],[7,9],[5,5]]]]"), ("Point", "[3.5,4.5]"), ("Circle", "[1,1]")]
    path = put(tmp_path, "f.jsonl", "\n".join(f'{{"geometry": {{"type": "{t}", "coordinates": {c}}}, "properties": {{"id": "{t}"}}}}' for t, c in shapes))
    got = {r.id: (r.lng, r.lat) for r in readers.features(spark, path, (-10.0, -10.0, 10.0, 10.0), ["id"], lines=True).collect()}
    assert got == {"Polygon": (2, 1), "LineString": (1, 3), "MultiPolygon": (3.5, 4.5), "Point": (3.5, 4.5)}


def test_a_header_may_hold_a_comma(spark, tmp_path):
    path = put(tmp_path, "c.csv", '"Name, full",Number,State,Code\n"A, B Ltd",7,Active,56101\n')
    got = readers.companies(spark, path, ["56"], {"name": ["Name, full"], "number": ["Number"], "status": ["State"], "codes": ["Code"]}).first()
    assert (got.name, got.number) == ("A, B Ltd", "7")


def test_raw_copies_name_what_is_missing(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    one, two = (sinks.raw_copies(spark, str(tmp_path / n), {"t": x}, {"u": "not delivered"}).orderBy("name").collect() for n, x in (("a", df), ("b", df.repartition(3))))
    assert [(r.name, r.rows, r.reason) for r in one] == [("t", 2, None), ("u", None, "not delivered")] and one[0].sha256 == two[0].sha256
