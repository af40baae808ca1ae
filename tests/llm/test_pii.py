import pytest
from helpers import EVENTS, event

from threadloom.llm import pii


def found(text):
    return [(k, text[a:b]) for a, b, k in pii.find_in_text(text)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Send it to ann.lee+ci@mail.example.", [("EMAIL", "ann.lee+ci@mail.example")]),
        ("(mailto:ANN_LEE@uni-x.example)", [("EMAIL", "ANN_LEE@uni-x.example")]),
        ("write ann (at) mail (dot) example please", [("EMAIL", "ann (at) mail (dot) example")]),
        ("so bekommen. ann.lee[at]mail.example.\nVon", [("EMAIL", "ann.lee[at]mail.example")]),
        ("cc ann＠mail.example on it", [("EMAIL", "ann＠mail.example")]),
        ("clone git@code.x.test:tools/a.git, pin @x/core@2.1.0", []),
        ("look at the card first, at once", []),
        ("ring +49 (0)30 23125 415, ext. 22", [("PHONE", "+49 (0)30 23125 415")]),
        ("tel ０７７００ ９００１２３ now", [("PHONE", "０７７００ ９００１２３")]),
        ("+33 1 99 00 43 95 23 cards", [("PHONE", "+33 1 99 00 43 95")]),
        ("(415) 555-0123 (mobile), 030/23125829", [("PHONE", "(415) 555-0123"), ("PHONE", "030/23125829")]),
        ("build 2025-0031-55, v3.12.0-rc.2 on port 8052, cost 1,206.50, counted 1000000095 ms, 10:00-12:30", []),
        ("ssn on file: 666-45-7338", [("ID_NUMBER", "666-45-7338")]),
        ("see span 441029384756102972", []),
        ("身份证号99238419870215011X", [("ID_NUMBER", "99238419870215011X")]),
        ("passport no. X11738228 and Reisepass K34548806", [("ID_NUMBER", "X11738228"), ("ID_NUMBER", "K34548806")]),
        ("tax id 04 244 140 839, Steuer-ID 08618724105, 护照号 Q44895404", [("ID_NUMBER", "04 244 140 839"), ("ID_NUMBER", "08618724105"), ("ID_NUMBER", "Q44895404")]),
        ("ship to 193B Old Talmere Road, Flat 3.", [("ADDRESS", "193B Old Talmere Road")]),
        ("he lives at 91 ASKERBY COURT, 90263 Norrmouth Kesulf asked for it.", [("ADDRESS", "91 ASKERBY COURT"), ("NAME", "Kesulf")]),
        ("wohnt Am Brunnplatz 12a, 00401 Halmstedt", [("ADDRESS", "Am Brunnplatz 12a")]),
        ("an Torveler Straße 159 und Sorrelstr. 87", [("ADDRESS", "Torveler Straße 159"), ("ADDRESS", "Sorrelstr. 87")]),
        ("a Avenida Sorrel, 164.", [("ADDRESS", "Avenida Sorrel, 164")]),
        ("设备寄到澜川路110号。", [("ADDRESS", "澜川路110号")]),
        ("thanks, Dr. Ann Lee-Poe!", [("NAME", "Ann Lee-Poe")]),
        ("It works now. van Dorm, Lurulf asked for it.", [("NAME", "van Dorm, Lurulf")]),
        ("ping @D. O'Hara about this", [("NAME", "D. O'Hara")]),
        ("build is green ann lee hat danach gefragt.", [("NAME", "ann lee")]),
        ("Gruß, Glyane Der Faden fehlt.", [("NAME", "Glyane")]),
        ("ask Harbor Export bot, the Monday Review release", []),
        ("x" * 80 + "@example.com", [("EMAIL", "x" * 80 + "@example.com")]),
        ("手机：+1 (202) 555-0102 ok, tel:+49 30 23125-104", [("PHONE", "+1 (202) 555-0102"), ("PHONE", "+49 30 23125-104")]),
        ("order 11010519491231002X, order 110105194912310021, 身份证号110105194912310021", [("ID_NUMBER", "11010519491231002X"), ("ID_NUMBER", "110105194912310021")]),
        ("", []),
        (" 　", []),
    ],
)
def test_values(text, want):
    assert found(text) == want


def test_names():
    at = lambda x: [(k, x[a:b]) for a, b, k in pii.find_in_name(x)]
    assert at("Ann Lee <ann.lee@mail.example>") == [("NAME", "Ann Lee"), ("EMAIL", "ann.lee@mail.example")]
    assert at("Dr. Ann van Lee (on leave)") == [("NAME", "Ann van Lee")]
    for nobody in ("release-crew", "Lane Keeper Bot", "整理助手", "intake form", "oncall", "relay-bot (server)", "Data Intake", "Build Alerts", ""):
        assert at(nobody) == []


def test_rest_stays_as_it_is():
    assert pii.redact("call ann@mail.example,\n  or (415) 555-0123!") == "call [EMAIL],\n  or [PHONE]!"
    assert pii.redact(None) is None and pii.redact("") == ""


def test_table(spark):
    long = "word " * 40_000 + "ann@mail.example"
    rows = [event(1, text="ann@mail.example ann@mail.example", name="Ann Lee"), event(1, text=long), event(2), event(3, text="", name=" ")]
    df = spark.createDataFrame(rows, EVENTS)
    got = sorted(tuple(r) for r in pii.personal_data(df).collect())
    assert got == [(1, "name", "NAME", "Ann Lee"), (1, "text", "EMAIL", "ann@mail.example"), (1, "text", "EMAIL", "ann@mail.example")]
    assert pii.redacted(df).columns == df.columns
    assert pii.personal_data(df.limit(0)).count() == 0


# Sentences written for this test, with the names that stand in them.
HELD_OUT = [
    ("Please contact John Smith tomorrow.", ["John Smith"]), ("My name is Maria Garcia and I run the batch.", ["Maria Garcia"]), ("I spoke with Anna Schmidt yesterday.", ["Anna Schmidt"]),
    ("All done.\n\nRegards,\nJohn Smith", ["John Smith"]), ("Best,\nTom", ["Tom"]), ("Dear Dr. Weber,\nthe run failed.", ["Weber"]), ("Hi Anna, can you look?", ["Anna"]),
    ("Mr. Jones called about the export.", ["Jones"]), ("Sehr geehrte Frau Müller-Lüdenscheidt,", ["Müller-Lüdenscheidt"]), ("Ich heiße Jürgen Müller.", ["Jürgen Müller"]),
    ("Wenden Sie sich an Petra van der Linden.", ["Petra van der Linden"]), ("Herr Krause wartet, wenn der Lauf endet.", ["Krause"]), ("Me llamo Lucía Fernández.", ["Lucía Fernández"]),
    ("Hola María, ¿qué tal?", ["María"]), ("Hablé con Pedro de la Cruz ayer.", ["Pedro de la Cruz"]), ("La señora Ortega llamó.", ["Ortega"]), ("我叫王小明，刚来。", ["王小明"]), ("联系人：李娜。", ["李娜"]),
    ("It was signed by J. Doe on the form.", ["J. Doe"]), ("The ticket is assigned to Ravi Patel.", ["Ravi Patel"]), ("Prof. O'Neill reviewed it.", ["O'Neill"]), ("Reported by Chloé Dubois this morning.", ["Chloé Dubois"]),
    ("Saludos,\nCarmen Ruiz", ["Carmen Ruiz"]), ("Viele Grüße\nSabine Vogel", ["Sabine Vogel"]), ("She met with Lars Holm and left.", ["Lars Holm"]),
    ("thanks, Monday!", []), ("per policy: nothing is kept", []), ("as manager said, wait", []), ("Hello World", []), ("Hi there, all good", []), ("Hi Team,", []), ("contact Support Team now", []), ("best practice says so", []),
    ("Assigned to Build Bot", []), ("The Monday Review release is out.", []), ("Please contact the desk.", []), ("Dear customer,", []), ("Regards", []), ("我叫你来看一下。", []), ("talk to Export Service first", []), ("It runs on Apache Spark in New York.", []),
]


def test_names_in_held_out_sentences():
    right = shown = wanted = 0
    for text, names in HELD_OUT:
        got = [v for k, v in found(text) if k == "NAME"]
        right += len(set(got) & set(names))
        shown += len(got)
        wanted += len(names)
    assert right / wanted >= 0.9 and right / shown >= 0.9


def test_many_anchors_take_linear_time():
    import time

    def seconds(n):
        began = time.perf_counter()
        for text in ("a.b@:x://" * n, "ab (at) cd " * n, "x1 +4930 " * n, "ab asked for it " * n, "某路" * n):
            pii.find_in_text(text)
        return time.perf_counter() - began

    seconds(500)
    assert seconds(8000) < 16 * seconds(1000) + 0.5
