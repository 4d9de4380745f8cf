import random

import pytest

from tillroll.llm.components import connected


def brute(edges):
    root = {n: n for e in edges for n in e}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for e in edges if e[0] != e[1] for n in e}


def cases():
    pick = random.Random(5)
    name = lambda n: b"%04d" % n
    path = [(name(i), name(i + 1)) for i in range(40)]
    star = [(name(900), name(i)) for i in range(100, 160)]
    some = [(name(pick.randrange(300, 600)), name(pick.randrange(300, 600))) for _ in range(150)]
    return [[], [(name(1), name(1))], path, star, path + star + some + some[:20]]


@pytest.mark.parametrize("edges", cases())
def test_equals_union_find(spark, edges):
    got = connected(spark.createDataFrame(edges, "a BINARY, b BINARY")).collect()
    assert {(bytes(r.a), bytes(r.root)) for r in got} == set(brute(edges).items())
    assert len(got) == len(brute(edges))
