import random

from triagelake.llm.personal_data import find_personal_data, train

from . import plain
from .conftest import clashing

ODD = [
    "x@y.co x@y.z.w@q.r a@b _c@d.e.f .@x.y", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1.2.3 00000000000000000001.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111111 5500005555555559 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
    "+1 (555) 123-4567 ++1 2 3 +12345678901234567890 +1 234 567 89 (0)", "1" * 30000, "a.b" * 20000 + "@x.y", "+" * 1000 + "1" * 2000,
    "ünïcödé @ x +49 (30) 1234567 é@b.c ñ1.2.3.4", "\U0001d4b3\U0001d4b3 a@b.cd \U0001d4b3 1.1.1.1 b@c.d", "@" * 500 + ".a" * 500, "a@" + "b." * 9000 + "c",
]


def test_base_against_plain_version(documents, odd_rows):
    dice = random.Random(6)
    pieces = ["a@b.c", "9.8.7.6", "+1 222 333 4444", "4111111111111111", " ", ".", "@", "-", "7", "x", "\n", "(", "é"]
    rows = [*odd_rows, *((100 + i, t) for i, t in enumerate(ODD)), (7, "again a@b.cd"), (None, "no id 1.2.3.4")]
    rows += [(1000 + i, "".join(dice.choice(pieces) for _ in range(dice.randrange(60)))) for i in range(200)]
    found = find_personal_data(clashing(documents(rows))).collect()
    got = sorted(((r.doc_id, [r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) for r in found), key=repr)
    assert got == sorted(((i, plain.base_spans(t)[0], plain.sha(plain.base_spans(t)[1])) for i, t in rows), key=repr)
    texts = {i: t for i, t in rows if i != 7}
    for r in found:  # spans of the base stay, and what is added keeps the order
        if r.doc_id in texts:
            assert set(plain.base_spans(texts[r.doc_id])[1].split(",")) <= set(r.spans.split(","))
    assert find_personal_data(documents([])).collect() == []


def test_loose_spans_are_added_where_labelers_agree(documents):
    rows = [(i, f"mail ann{i}@example.com or call +1 (555) 010-{1000 + i}") for i in range(50)]
    text = "contact: john (at) example (dot) com, phone 212-555-0199"
    rows += [(100, text), (101, "order 112-555-0199 and serial 012-555-0199")]
    found = {r.doc_id: r.spans for r in find_personal_data(documents(rows)).collect()}
    assert found[100] == f"email:9:{text.index(',')},phone:{text.index('212')}:{len(text)}"
    assert found[101] == ""


def test_classifier_follows_the_posteriors():
    counts = {(0, (1, 1, 1)): 500, (0, (1, 1, 0)): 300, (0, (0, -1, -1)): 40, (3, (0, 1, 1)): 20, (3, (0, 0, -1)): 30, (1, (1, 0, 0)): 100}
    found, weights = train(counts)
    assert found.log_odds((1, 1, 1)) > 0 > found.log_odds((0, -1, -1))
    assert len(weights) == 1 + 3 + 6
