"""Scripts, check digits, country codes; distinctness, forced meetings and corpus-wide gender."""

import re

import pytest

from siftwell.llm import pii

KEY = b"k"


@pytest.mark.parametrize("text", ["Dr. 王小明", "Mr. محمد علي", "Dr נועם כהן", "Mx 김민준", "г-н Иван Петров", "Frau Σοφία Παππά", "my name is Ana Ruiz", "Mr Արամ Խաչ"])
def test_scripts(text):
    out, kinds = pii.replace(text, KEY)
    name = text.split(" ", 1)[1] if not text.startswith("my") else "Ana Ruiz"
    assert kinds == ["name"] and not any(w in out for w in name.split(" "))
    assert {pii.script_of(w).split(" ")[-1] for w in out.split(" ")[-len(name.split(" ")) :] if "is" not in w} == {pii.script_of(name).split(" ")[-1]}


def test_mentions_in_scripts_without_spaces():
    out = pii.replace("Dr. 王小明来过", KEY)[0], pii.replace("Dr. 王小明, 王小明来过", KEY)[0]
    assert "王小明" not in out[1] and out[1].count(out[1][4:7]) == 2


def test_numbers_keep_what_tells_their_kind():
    for i in range(200):
        rest = f"4{i:014d}"
        card = rest + str(pii._luhn(rest))
        new = pii.surrogate("card", card, "", KEY)
        assert new != card and pii._luhn(new[:-1]) == int(new[-1])
        wrong = rest + str((pii._luhn(rest) + 3) % 10)
        assert int(pii.surrogate("card", wrong, "", KEY)[-1]) != pii._luhn(pii.surrogate("card", wrong, "", KEY)[:-1])
        account = f"37040044{i:010d}"
        iban = f"DE{98 - pii._mod97(account + 'DE00'):02d}{account}"
        new = pii.surrogate("iban", iban, "", KEY)
        assert new != iban and new.startswith("DE") and pii._mod97(new[4:] + new[:4]) == 1
        assert pii.surrogate("phone", f"+49{i:09d}", "", KEY).startswith("+49") and pii.surrogate("phone", f"+420{i:09d}", "", KEY).startswith("+420")
    assert len({pii.surrogate("card", f"{i:015d}" + "7", "", KEY) for i in range(3000)}) == 3000


def rows():
    people = [f"{a}{b}" for a in ("An", "Bo", "Cy", "Di") for b in ("na", "ris", "dor", "lek", "mun")]
    out = [(i, f"{('Mr', 'Mrs', 'Dr')[i % 3]} {p} Olsen wrote to {p}@mail.org or +49 30 {1000000 + i}; {p} left.") for i, p in enumerate(people * 2)]
    return [*out, (90, None), (91, ""), (92, "Dr Zed Quill"), (93, "Mrs Zed Quill"), (94, "plain"), (None, "Mr Anna Olsen")]


def test_forced_meetings_stay_distinct(spark, monkeypatch):
    # One surrogate for all names at the first draw, two at the second: every entity must still end apart.
    real = pii.surrogate.__wrapped__

    def narrow(kind, value, gender, key, draw=0):
        if kind == "name" and draw < 2:
            return " ".join(("xa", "xb")[(sum(map(ord, value)) % 2) * draw] for _ in value.split(" "))
        return real(kind, value, gender, key, draw)

    mentions = spark.createDataFrame([(v, g) for v in [f"p{i} q" for i in range(40)] + ["xa xa"] for g in "mf"], "value string, gender string").selectExpr("1L AS row", "'name' AS kind", "value", "gender")
    monkeypatch.setattr(pii, "surrogate", narrow)
    monkeypatch.setattr(pii, "_with_forms", lambda rows, key: spark.createDataFrame([(r["kind"], r["value"], r["gender"], r["draw"], narrow(r["kind"], r["value"], r["gender"], key, r["draw"])) for r in rows.select("kind", "value", "gender", "draw").collect()], "kind string, value string, gender string, draw int, form string"))
    got = pii.settled(mentions, KEY).collect()
    forms = [narrow("name", r["value"], r["as"], KEY, r["draw"]) for r in got]
    assert len(got) == 82 and len(set(forms)) == 82 and not set(forms) & {r["value"] for r in got} and max(r["draw"] for r in got) >= 2


def test_corpus(spark):
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows())], "doc_id long, text string, row int").repartition(3)
    got = {r["doc_id"]: r for r in pii.pseudonymize(docs, KEY).collect()}
    assert len(got) == len(rows()) and got[90]["text"] is None and got[91]["text"] == "" and got[94]["text"] == "plain"
    # A gender that one text does not tell is another text's; one person has one surrogate in all texts.
    assert got[92]["text"].split(" ")[1:] == got[93]["text"].split(" ")[1:]
    first = {}
    for doc_id, text in rows():
        if doc_id is not None and doc_id < 40:
            name, new = text.split(" ")[1], got[doc_id]["text"]
            assert name not in re.sub("@.*? or", "", new) and got[doc_id]["entity_types"] == "name,email,phone,name"
            surrogate = new.split(" ")[1]
            assert new.rstrip(".").split(" ")[-2] == surrogate
            first.setdefault(name, set()).add(surrogate)
    given = [next(iter(x)) for x in first.values()]
    mails = {r["text"].split(" ")[5] for r in got.values() if r["doc_id"] is not None and r["doc_id"] < 20}
    assert len(mails) == 20 and len(set(given)) == len(first)
