import re

from helioquery.llm.pii import replace_pii


def luhn(s):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(s))) % 10


def test_labels_and_titles_in_any_case(spark):
    rows = [
        (1, 'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"'), (2, 'TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"'),
        (3, "Password: Zx81-Quartz API_KEY=ABCXYZ99"), (4, "Mr. John Smith"), (5, "MR. JOHN SMITH"),
        (6, "FRAU MÜLLER; г-н Иван Петров; Г-Н ИВАН ПЕТРОВ"), (7, "monsieur Dupont"), (8, "THE ITEMS DESIRED"),
    ]
    got = {r["doc_id"]: (r["text"], r["n_entities"]) for r in replace_pii(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    assert [got[i][1] for i in range(1, 9)] == [1, 1, 2, 1, 1, 3, 1, 0]
    assert got[1][0].upper() == got[2][0] and "9233A8" not in got[2][0] and re.fullmatch(r'TOKEN = "[0-9A-F]{40}"', got[2][0])
    assert re.fullmatch(r"Password: \S{11} API_KEY=[A-Z]{6}\d\d", got[3][0]) and "Quartz" not in got[3][0] and "XYZ" not in got[3][0]
    assert got[4][0].upper() == got[5][0] and "SMITH" not in got[5][0]
    frau, low, high = re.fullmatch(r"FRAU (\w+); г-н (\w+ \w+); Г-Н (\w+ \w+)", got[6][0]).groups()
    assert frau.isupper() and frau != "MÜLLER" and low.upper() == high != "ИВАН ПЕТРОВ"
    assert got[7][0].startswith("monsieur ") and "Dupont" not in got[7][0] and got[8][0] == rows[7][1]


def test_no_entity_in_any_case_is_left(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    planted = re.compile(r"\S+@\S+\.com|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|AKIA[A-Z0-9]{16}|password=\w+|token = \"\w+|\b\d{1,3}(?:\.\d{1,3}){3}\b", re.I)
    # a number of 16 digits is a card if its check digit is right; others are no personal data and stay
    own = lambda rows: [m for r in rows for m in planted.findall(r["text"]) if not m.isdigit() or luhn(m) == 0]
    before, after = own(docs.collect()), own(replace_pii(docs, "k").collect())
    left = [m for m in after if m in set(before)]
    assert len(after) == len(before) > 500 and not left, (len(after), len(before), len(left), left[:3])
