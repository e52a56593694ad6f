import pytest
from pyspark.sql import functions as F

from placeloom.functions import geo, hours, pages, scores
from placeloom.functions import text as T


def one(spark, expr, **values):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return df.select(expr.alias("x")).first().x


def test_names(spark):
    names = [("The Fish & Chips Ltd.", "fish and chips", "the fish chips ltd", "thefishchipsltd"), (None, "", "", ""), ("Kahvila Öljy Oy", "kahvila öljy", "kahvila ljy oy", "kahvilaöljyoy"), ("  ", "", "", "")]
    df = spark.createDataFrame(names, "n string, a string, b string, c string")
    for r in df.select("*", T.normal_name("n").alias("x"), T.ascii_name("n").alias("y"), T.dedupe_name("n").alias("z")).collect():
        assert (r.x, r.y, r.z) == (r.a, r.b, r.c)
    assert one(spark, T.register_name(F.lit("Oy Ab Tavu Oy Ltd"))) == "tavu"
    assert one(spark, T.folded_name(F.lit("Café Åäö's"))) == "cafe aao s"
    assert one(spark, T.rule_name(F.lit("The Molly's Ltd"))) == "mollys"


@pytest.mark.parametrize(
    ("a", "b", "score"),
    [("Otter and Lantern", "Otter & Lantern Pub", 0.9), ("Blue Dog Inn", "Blue Cat Inn Bar", 0.5), ("Martenboat", "Marten Boat Inn", 0.9), ("Red Rooms", "Blue Rooms", 0.5), ("", "Blue", 0.0), ("Al", "Bo", 0.0)],
)
def test_name_score(spark, a, b, score):
    assert one(spark, T.name_score(F.lit(a), F.lit(b))) == pytest.approx(score)


def test_town_words_are_no_brand(spark):
    assert one(spark, T.anchored_score(F.lit("Emberline London"), F.lit("Tallow of London"))) == 0
    assert one(spark, T.anchored_score(F.lit("Leigh"), F.lit("Leigh Station"))) == 0
    args = (F.lit(0.5), F.lit(10.0), F.lit(True))
    assert not one(spark, T.accept(F.lit("Emberline London"), F.lit("Tallow London"), *args))
    assert one(spark, T.accept(F.lit("Hot Radishes"), F.lit("HotRadishes Grill"), F.lit(0.0), F.lit(99.0), F.lit(None).cast("boolean")))
    assert [one(spark, T.brand_gate(F.lit("Pilka Coffee High Street"), F.lit(b))) for b in ("Pilka", "High Street", "B&M", "B M", "")] == ["yes", "no", "no", "initials", "no"]


def test_same_brand(spark):
    pairs = [("Oko Convenience", "Oko Foods", True), ("Wex-o Food", "Wex-o", True), ("mu", "MU", True), ("Fern", "Tulip", False), ("Old Bar", "New Bar", False)]
    for a, b, same in pairs:
        assert one(spark, T.same_brand(F.lit(a), F.lit(b))) is same, (a, b)


def test_addresses(spark):
    rows = [("18, Stoke Road", "18", "stoke road"), ("The Otter, 6 - 8 Church Road", "6", "the otter"), ("66-68 High St", "66", "high st"), ("Nowhere", None, "nowhere"), (None, None, "")]
    for a, hn, street in rows:
        assert one(spark, T.house_number(F.lit(a).cast("string"))) == hn
        assert one(spark, T.street_key(F.lit(a).cast("string"))) == street
    assert one(spark, T.trailing_number(F.lit("Koivutie 62 B, Helsinki"))) == "62 b"
    assert one(spark, T.postcode_in(F.lit("5 High St, SS1 1AA London"))) == "ss11aa" and one(spark, T.postcode_in(F.lit("Tie 3, 00100 Helsinki"))) == "00100"


def test_urls(spark):
    got = [one(spark, T.url_key(F.lit(u).cast("string"))) for u in ("https://www.A.example/Store/1/?q=2#x", "a.example/", "http://", " a b ", None)]
    assert [tuple(g) if g else None for g in got] == [("a.example/store/1", True), ("a.example", False), None, None, None]
    assert [one(spark, T.site_kind(F.lit(u).cast("string"))) for u in ("https://m.facebook.com/x", "booking.com/h", "own.example", None)] == ["social", "marketplace", "own", None]


def test_geo(spark):
    assert one(spark, geo.planar_m(F.lit(0.0), F.lit(0.0), F.lit(0.001), F.lit(0.0))) == pytest.approx(111.32)
    assert one(spark, geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))) == pytest.approx(20015086.8, rel=1e-6)
    assert tuple(one(spark, geo.tile(F.lit(51.5), F.lit(0.0)))) == (8192, 5448)
    assert one(spark, geo.segment_m(F.lit(0.001), F.lit(0.0), F.lit(0.0), F.lit(-1.0), F.lit(0.0), F.lit(1.0))) == pytest.approx(111.32)
    assert one(spark, geo.segment_m(F.lit(0.001), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0))) == pytest.approx(111.32)
    assert one(spark, geo.parse_box(F.lit("1, 2,3,x"))) is None and one(spark, geo.parse_box(F.lit("1, 2,3,4"))) == [1, 2, 3, 4]


@pytest.mark.parametrize(("stars", "bayes", "share", "good"), [([58, 13, 12, 7, 1], 4.300, 71 / 91, True), ([1, 0, 0, 0, 0], 4.205, 1.0, False), ([0, 0, 10, 0, 0], 3.562, 0.0, False), ([6, 0, 0, 0, 0], 4.453, 1.0, True), ([977, 392, 0, 0, 0], 4.709, 1.0, True)])
def test_ratings(spark, stars, bayes, share, good):
    s = F.array(*map(F.lit, stars))
    assert one(spark, scores.bayes_rating(s, F.lit(4.125))) == pytest.approx(bayes, abs=0.0011)
    assert one(spark, scores.positive_share(s)) == pytest.approx(share)
    assert one(spark, scores.recommended(scores.bayes_rating(s, F.lit(4.125)), F.lit(sum(stars)))) is good


def test_review_bands(spark):
    assert [one(spark, scores.review_band(F.lit(n).cast("int"))) for n in (None, 4, 13, 18, 94, 96, 130)] == ["", "4", "~15", "~20", "~90", "~100", "~150"]


@pytest.mark.parametrize(("days", "weight"), [(181, 0.7), (182, 0.7), (364, 0.5005), (547, 0.3), (9999, 0.3)])
def test_trust_runs_down(spark, days, weight):
    e = scores.legs(F.array(F.lit("osm")), F.lit(days))
    got = one(spark, F.aggregate(e, F.lit(0.0), lambda acc, x: acc + scores.leg_weight(x["rule"], x["age"])))
    assert got == pytest.approx(weight, abs=1e-3)


def test_tier_is_capped(spark):
    many = F.array(*map(F.lit, ("fsa", "servicemap", "ch", "atp", "osm")))
    assert one(spark, scores.tier(scores.legs(many, F.lit(1)))) == 3.0
    assert one(spark, scores.tier(scores.legs(F.array(F.lit("osm"), F.lit("fsa")), F.lit(None).cast("int")))) == 1.7
    assert one(spark, scores.place_rank(F.lit(1.7), F.lit(4.3))) == 17.43


def test_hashes_and_dates(spark):
    h = 5381
    for c in "abc":
        h = (h * 33 + ord(c)) & 0xFFFFFFFF
    digits = ""
    while h:
        h, r = divmod(h, 36)
        digits = "0123456789abcdefghijklmnopqrstuvwxyz"[r] + digits
    assert one(spark, scores.text_hash36(F.lit("abc"))) == digits
    assert [str(one(spark, scores.any_date(F.lit(v)))) for v in ("2030-01-02", "02/01/2030", "x")] == ["2030-01-02", "2030-01-02", "None"]
    assert one(spark, scores.affirmed(F.lit(" y "))) is True and one(spark, scores.affirmed(F.lit("N"))) is None


# --- opening hours


@pytest.mark.parametrize(
    ("text", "day", "ranges"),
    [("24/7", "We", [(0, 1440)]), ("Mo-Fr 09:00-17:00; Sa 10:00-00:00", "Sa", [(600, 1440)]), ("Fr-Mo 10:00-12:00", "Su", [(600, 720)]), ("Su off", "Su", []), ("Mo-Sa 11:00-14:00,18:00-22:00", "Tu", [(660, 840), (1080, 1320)]), ("Mo,We 09:00-10:00", "We", [(540, 600)]), ("Mo-Fr 09:00-17:00", "Su", None), ("call us", "Mo", None), ("", "Mo", None)],
)
def test_reading_a_week(spark, text, day, ranges):
    got = one(spark, hours.week(F.lit(text)))
    assert ([tuple(r) for r in got[day]] if day in got else None) == ranges


@pytest.mark.parametrize("text", ["Mo-Fr 09:00-17:00; Sa 10:00-14:00", "Mo 09:00-12:00,13:00-17:00", "Mo-Su 00:00-24:00", "Tu 18:00-02:00"])
def test_writing_is_the_reverse_of_reading(spark, text):
    assert one(spark, hours.written(hours.week(F.lit(text)))) == text


def test_reading_as_compared(spark):
    got = one(spark, hours.week(F.lit("Sa-Mo 09:00-12:00, 14:00-18:00;Mo 07:00-08:00; x; Tuesday 09:00-10:00"), "plain"))
    assert {d: [tuple(r) for r in rs] for d, rs in got.items()} == {"Sa": [(540, 720)], "Su": [(540, 720)], "Mo": [(420, 480), (540, 720)], "Tu": [(540, 600)]}
    assert one(spark, hours.week(F.lit(None).cast("string"), "plain")) is None and one(spark, hours.written(hours.week(F.lit("x"), "plain"))) is None


def test_other_grammars():
    w = hours.write_week
    assert w(hours.read_finnish("ma-pe 11.30-2.00, la 12-18\nsu suljettu\nma 1.5.2030 10-12")) == "Mo-Fr 11:30-02:00; Sa 12:00-18:00"
    assert w(hours.read_finnish("ti-to\n  10.30-14.30\n  16.30-21.30\nla suljettu\n 10.00-12.00")) == "Tu-Th 10:30-14:30,16:30-21:30"
    assert w(hours.read_finnish("1.5.2030-1.6.2030\n10.00-12.00\nma varauksella\n10.00-11.00\npe 9.00-0.00\nsu kiinni")) == "Fr 09:00-24:00"
    assert w(hours.read_day_map('{"monday": "11-23", "tiistai": "10.30-14", "x": 3}')) == "Mo 11:00-23:00; Tu 10:30-14:00"
    assert w(hours.read_day_map("not json")) == w(hours.read_day_map(None)) == ""
    assert w(hours.read_specification('[{"dayOfWeek": ["https://schema.org/Monday", "Tuesday"], "opens": "09:00", "closes": "17:00"}, 7]')) == "Mo-Tu 09:00-17:00"
    assert w(hours.read_week_slots('[{"day": "Mon", "type": "ALL_DAY"}, {"day": "Tue", "type": "RANGE", "from": "8:00", "to": "16:30"}, {"day": "Wed", "type": "RANGE", "from": "8:00", "to": "9:00", "exceptional": true}]')) == "Mo 00:00-24:00; Tu 08:00-16:30"


@pytest.mark.parametrize(
    ("text", "rules"),
    [("Mon-Fri 8 - 9pm", ["Mo-Fr 20:00-21:00"]), ("Monday 9 - 5pm", ["Mo 09:00-17:00"]), ("Sun 12-5", ["Su 12:00-17:00"]), ("Sun 11-12", ["Su 11:00-12:00"]), ("TUESDAY 2-4", []), ("Mon and Wed 9am to 12pm, 1pm-5pm", ["Mo,We 09:00-12:00", "Mo,We 13:00-17:00"]), ("Sat 12:00-22:00", ["Sa 12:00-22:00"]), ("nothing", []), (None, [])],
)
def test_spoken_hours(text, rules):
    assert [r for r, _, _ in hours.read_spoken(text)] == rules


def test_delivery_hours_are_marked_and_never_win(spark):
    text = "Delivery Hours: Mon-Sun 5pm-11pm. Opening hours Mon-Fri 9am-5pm"
    assert [k for _, _, k in hours.read_spoken(text)] == ["delivery", "dine-in"]
    v = one(spark, hours.verdict(F.lit(None).cast("string"), hours.spoken(F.lit(text))))
    assert (v.primary, v.conflict) == ("Mo-Fr 09:00-17:00", False)


def test_reconciling(spark):
    def r(structured, said):
        rules = F.array(*(F.struct(F.lit(t).alias("rule"), F.lit("").alias("raw"), F.lit("dine-in").alias("kind")) for t in said)) if said else F.array().cast("array<struct<rule:string,raw:string,kind:string>>")
        v = one(spark, hours.verdict(F.lit(structured).cast("string"), rules))
        return (v.primary, v.alt, v.method, v.conflict)

    assert r("Mo 09:00-17:00", ["Mo 09:00-17:00"]) == ("Mo 09:00-17:00", None, "agree", False)
    assert r("Mo-Fr 09:00-17:00", ["Mo-Sa 09:00-17:00"])[2] == "agree"
    assert r("Mo 09:00-22:00", ["Mo 12:00-14:00", "Mo 18:00-22:00"]) == ("Mo 12:00-14:00,18:00-22:00", None, "union", False)
    assert r("Mo 09:00-12:00", ["Mo 13:00-17:00", "Tu 13:00-17:00"]) == ("Mo 09:00-12:00,13:00-17:00; Tu 13:00-17:00", None, "union", False)
    assert r("Mo 09:00-17:00", ["Sa 09:00-17:00"]) == ("Sa 09:00-17:00", "Mo 09:00-17:00", "text", True)
    assert r("Mo 09:00-17:00", ["Mo 12:00-20:00"]) == ("Mo 12:00-20:00", "Mo 09:00-17:00", "text", True)
    assert r("Mo-Tu 09:00-17:00", ["Mo 12:00-20:00"])[2:] == ("structured", True)
    assert r("Mo 09:00-17:00", ["Mo 12:00-20:00", "Mo 13:00-21:00"])[2:] == ("structured", True)
    assert r(None, []) == (None, None, None, False) and r(None, ["Mo 09:00-10:00"])[2] == "text" and r("Mo 09:00-10:00", [])[2] == "structured"


def test_open_at(spark):
    def at(text, day, minute, strict=False):
        return one(spark, hours.open_at(hours.week(F.lit(text).cast("string")), F.lit(day), F.lit(minute), strict))

    late = "Fr 18:00-02:00"
    assert at(late, "Fr", 19 * 60) == "open" and at(late, "Sa", 60) == "open" and at(late, "Sa", 180) == "closed"
    assert at(late, "Fr", 19 * 60, True) == "closed"
    assert at("Su 20:00-03:00", "Mo", 10) == "open" and at("", "Mo", 10) == at(None, "Mo", 10) == at("varies", "Mo", 1) == "unknown" and at("Mo off", "Mo", 600) == "closed"


def test_same_hours(spark):
    w = lambda t: hours.week(F.lit(t))
    assert one(spark, hours.same_hours(w("Mo,Tu 09:00-10:00"), w("Tu 09:00-10:00; Mo 09:00-10:00"))) is True
    assert one(spark, hours.clean_ranges(F.lit("09:00-12:30, 14:00 - 19:00,CLOSED"))) == "09:00-12:30,14:00 - 19:00" and one(spark, hours.clean_ranges(F.lit("CLOSED"))) is None


def test_fields_of_single_sources(spark):
    fields = lambda rules, *texts: one(spark, hours.split_fields(F.lit(rules).cast("array<string>"), *(F.lit(t).cast("string") for t in texts)))
    assert fields(["Mo-Fr 10:00-20:00", None, "Sa 10:00-18:00"], None, None, None) == "Mo-Fr 10:00-20:00; Sa 10:00-18:00"
    assert fields(None, "10:00-20:00 ", "closed", "12:00-16:00") == "Mo,Tu,We,Th,Fr 10:00-20:00; Su 12:00-16:00" and fields([], "", None, "x") is None
    modes = F.array(*(F.struct(F.lit(d).alias("day"), F.lit(m).alias("mode")) for d, m in (("Monday", "24H"), ("Tue", "6:00-22:00"), ("Sat", "BY_AGREEMENT"), ("x", "24H"))))
    assert one(spark, hours.day_modes(modes)) == "Mo 00:00-24:00; Tu 6:00-22:00"


# --- pages

PAGE = """<html><head><title> The  Inn </title><meta content="Nice &amp; warm" name="description"><meta property="og:site_name" content="Inn Ltd">
<script type="application/ld+json">{"@graph": [{"name": "The Inn", "address": {"name": "Here"}}]}</script><script type="application/ld+json">{broken</script><style>p{}</style></head>
<body><p>Tom&nbsp;&amp; Ann<br>eat</p><img alt="A dish"><a href="/contact">c</a><a href='https://other.example/opening'>o</a><a href="mailto:x@y">m</a><a href="/contact">c</a></body></html>"""


def test_pages(spark):
    p = F.lit(PAGE)
    assert one(spark, pages.visible_text(p)) == "The Inn Tom & Ann eat A dish c o m c"
    assert one(spark, pages.title(p)) == "The Inn" and one(spark, pages.meta(p, "description")) == "Nice &amp; warm" and one(spark, pages.meta(p, "keywords")) is None
    assert one(spark, pages.identity(p)) == ["The Inn", "Inn Ltd", "Here"]
    assert one(spark, pages.links(p)) == ["/contact", "https://other.example/opening"] and one(spark, pages.hour_links(p, F.lit("own.example"))) == ["/contact"]
    assert one(spark, pages.linked_data(F.lit(None).cast("string"))) is None and one(spark, pages.needs_script(F.lit('<div id="root"></div>'))) is True


def test_name_on_page_has_three_values(spark):
    w = F.array(F.lit("inn"))
    none = F.lit(None).cast("string")
    assert one(spark, pages.name_on_page(w, F.lit("the INN"), none)) is True
    assert one(spark, pages.name_on_page(w, F.lit("a pub"), none)) is False
    assert one(spark, pages.name_on_page(w, none, none)) is None and one(spark, pages.name_on_page(F.array().cast("array<string>"), F.lit("x"), none)) is None


def test_tags_and_contacts(spark):
    tags = F.create_map(*map(F.lit, ("amenity", "pub", "contact:phone", "01", "phone", " ", "addr:street", "High St")))
    rules = [("shop", None, "shop"), ("amenity", {"cafe"}, "cafe"), ("amenity", {"pub", "bar"}, "pub")]
    assert one(spark, T.tag_match(tags, rules, "other")) == "pub" and one(spark, T.tag_match(F.create_map(F.lit("x"), F.lit("y")), rules, "other")) == "other"
    assert one(spark, T.contact(tags, "phone")) == "01" and one(spark, T.contact(tags, "email")) is None
    assert one(spark, T.joined(F.lit("5"), F.lit(" "), F.lit(None).cast("string"), F.lit("Town"))) == "5, Town"
    socials = F.array(F.lit("https://x.example/a"), F.lit("https://www.Facebook.com/b"))
    assert one(spark, T.pick_social(socials, ("facebook.com",))) == "https://www.Facebook.com/b" and one(spark, T.pick_social(socials, ("insta",))) is None
    assert [one(spark, T.is_handle(F.lit(v))) for v in ("@joe", "http://x", " ")] == [True, False, False]
    assert one(spark, T.slug(F.lit("eu/GB/Old Town"))) == "eu-gb-old-town" and one(spark, T.stem(F.lit("arms"))) == "arm" and one(spark, T.stem(F.lit("glass"))) == "glass"


def test_lists_and_confidence(spark):
    lists = lambda a, b: one(spark, scores.list_verdict(F.array(*map(F.lit, a)), F.array(*map(F.lit, b))))
    assert [lists(["a", "b"], ["a"]), lists(["a"], ["a", "c"]), lists(["a"], ["c"])] == ["agree", "extend", "conflict"]
    parts = F.array(F.struct(F.lit("meta").alias("dataset"), F.lit(0.9).alias("confidence")), F.struct(F.lit("x").alias("dataset"), F.lit(1.0).alias("confidence")))
    assert one(spark, scores.max_confidence(F.lit(0.5), parts, "meta")) == 0.9 and one(spark, scores.max_confidence(F.lit(None).cast("double"), parts, "none")) == 0.0
    assert one(spark, scores.half_life(F.lit(8.0), F.lit(20.0), 10.0)) == 2.0
    assert one(spark, scores.first_full(F.lit(" "), F.lit("b"))) == "b"
    assert one(spark, pages.host_is_dead(F.lit(2), F.lit("2031-01-01").cast("timestamp"), F.lit("2031-01-05").cast("timestamp"))) is True
