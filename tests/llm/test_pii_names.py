import re
from collections import defaultdict

from helioquery.llm.pii import replace_pii


def done(spark, *texts, key="k"):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = replace_pii(docs, key).orderBy("doc_id").collect()
    return [r["text"] for r in rows], [r["n_entities"] for r in rows]


def test_names_are_one_person_with_and_without_title(spark):
    (a, b, c, d), n = done(spark, "Mr. John Smith called. Later John Smith and Mr Smith met; Smithers not. Smith!", "Mrs Smith rang", "Mr Jack Smith", "MR. JOHN SMITH, JOHN SMITH")
    given, family = re.match(r"Mr\. (\S+) (\S+) called", a).groups()
    assert a == f"Mr. {given} {family} called. Later {given} {family} and Mr {family} met; Smithers not. {family}!" and n[0] == 4
    assert b == f"Mrs {family} rang" and c.endswith(" " + family) and c != f"Mr {given} {family}" and d == f"MR. {given} {family}, {given} {family}".upper()


def test_phones_agree_across_the_country_code(spark):
    (a,), n = done(spark, "+1 437 555 1520, 437 555 1520 or (437) 555-1520")
    one, two, three = re.match(r"\+1 (\S+ \S+ \S+), (\S+ \S+ \S+) or (.*)$", a).groups()
    assert one == two == re.sub(r"[()]", "", three).replace("-", " ") != "437 555 1520" and n == [3]


def mod97(iban):
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def test_accounts_and_addresses_keep_form_and_check_digits(spark):
    (a, b, c), n = done(spark, "DE89 3704 0044 0532 0130 00 = DE89370400440532013000", "part 4915100405443891, AB12 3456 7890 1234", "2001:db8:0:0:0:ff00:42:8329 and FE80::A1 at 12:30:45, std::x")
    spaced, tight = a.split(" = ")
    assert spaced.replace(" ", "") == tight != "DE89370400440532013000" and mod97(tight) == 1 and tight.startswith("DE") and [len(x) for x in spaced.split()] == [4, 4, 4, 4, 4, 2]
    assert b == "part 4915100405443891, AB12 3456 7890 1234" and n == [2, 0, 2]
    assert re.fullmatch(r"[0-9a-f]{4}:[0-9a-f]{3}:\d:\d:\d:[0-9a-f]{4}:\d\d:\d{4} and [A-F]{2}\d\d::[A-F]\d at 12:30:45, std::x", c) and "FE80" not in c


def test_empty_table_and_long_text(spark):
    empty = replace_pii(spark.createDataFrame([], "doc_id int, text string"), "k")
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "n_entities"]
    (long, none), n = done(spark, "word " * 300_000 + "Mr Smith x " + "Smith x " * 1000 + "x@y.example", "")
    assert n == [1002, 0] and "Smith" not in long and none == ""


def test_distinct_and_coreferent_by_brute_force(spark):
    """Every mention, aligned by its place, against the entity it stands for."""
    texts = [f"{'Mr' if k % 2 else 'Frau'} {'ABCDE'[k % 5]}nna K{'aeiou'[k % 5]}rl{'abcdefgh'[k // 9 % 8]} # 10.{k % 7}.3.{k % 11} # +1 (2{k % 9}0) 555-0{k % 90 + 100} # u{k % 30}@h{k % 4}.example" for k in range(400)]
    out, _ = done(spark, *texts)
    seen = defaultdict(set)
    for old, new in zip(texts, out):
        for kind, (a, b) in enumerate(zip(old.split(" # "), new.split(" # "), strict=True)):
            if kind:
                seen[kind, a].add(b)
            else:
                (title, given, family), (kept, to, name) = a.split(), b.split()
                assert title == kept
                seen["family", family].add(name)
                seen[title, given].add(to)
    assert all(len(v) == 1 for v in seen.values())
    for kind in {k for k, _ in seen}:
        own = [next(iter(v)) for (k, _), v in seen.items() if k == kind]
        assert len(set(own)) == len(own) > 4 and not set(own) & {a for k, a in seen if k == kind}
