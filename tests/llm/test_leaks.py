"""Decontamination against the brute-force version, on texts made from items by edits of all kinds."""

import random

import brute


def edited(rnd, words):
    words = list(words)
    for _ in range(rnd.randrange(6)):
        i = rnd.randrange(len(words) + 1)
        what = rnd.randrange(6)
        if what == 0:
            words.insert(i, rnd.choice(["oops", "Anna", "7", "km", "and"]))
        elif what == 1 and len(words) > 1:
            del words[min(i, len(words) - 1)]
        elif what == 2:
            words = words[:i] + [f"x{rnd.randrange(99)}"] * rnd.randrange(1, 12) + words[i:]
        elif what == 3:
            words = [{"Anna": "Boris", "Tom": "Zoe", "5": "8", "12": "30", "km": "miles"}.get(w, w) for w in words]
        elif what == 4:
            words = [rnd.choice(["Anna", "Tom"]) if w in ("Anna", "Tom") else w for w in words]
        else:
            words = words[i:] or words
    return words


def test_leaks_equal_brute_force(spark):
    from sparktrail.llm.decontaminate import leaks

    rnd = random.Random(11)
    pool = ["the", "cat", "and", "train", "leaves", "town", "clock", "far", "goes", "each", "hour", "when", "Anna", "Tom", "5", "12",
            "km", "How", "many", "Apples", "has", "ends.", "so,", "1,5", "(that)"]
    items = [(i, " ".join(rnd.choice(pool) for _ in range(n))) for i, n in enumerate((3, 4, 5, 7, 8, 8, 9, 12, 14, 20, 30, 45, 60))]
    items += [(90, "What is the capital of France?"), (91, "5 12 5 12 km Anna"), (92, None), (93, ""), (0, items[0][1])]
    docs = []
    for k in range(260):
        _, text = rnd.choice(items[:14])
        words = edited(rnd, text.split())
        around = [[rnd.choice(pool) for _ in range(rnd.randrange(12))] for _ in range(2)]
        text = " ".join([*around[0], *words, *around[1]])
        docs.append((k, text.replace(". ", ".\n") if k % 3 else text.upper() if k % 30 == 0 else text))
    docs += [(900, "What is the capital of Spain? It is Madrid."), (901, "so: what is the capital of France? Paris."), (902, None), (3, docs[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.item_id) for r in leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute.leaks(docs, items)
    assert got == want and len(want) > 60
    assert (901, 90) in got and (900, 90) not in got  # one window with other values is no leak
