import random

from tabloom.llm.components import components, extended


def brute(links):
    root = {}
    for a, b in links:
        if a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


def test_components_and_later_links(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in rng.sample(range(200), 170)] + [(500, x) for x in range(501, 560)] + [(7, 7), (900, 900)]
    links += [(b, a) for a, b in links[:20]]
    frame = spark.createDataFrame(links, "a long, b long")
    roots = components(spark, frame)
    assert {r["node"]: r["root"] for r in roots.collect()} == brute(links)
    more = [(3, 510), (700, 701), (701, 12), (4, 5)]
    after = extended(spark, roots, spark.createDataFrame(more, "a long, b long"))
    assert {r["node"]: r["root"] for r in after.collect()} == brute(links + more)
    none = spark.createDataFrame([], "a long, b long")
    assert components(spark, none).count() == 0
    assert extended(spark, roots, none).count() == roots.count()
