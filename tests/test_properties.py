"""Property tests against brute force on small random frames."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripmart.operators import staging as S

ROW = st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 3),
                st.one_of(st.none(), st.integers(-5, 5)), st.one_of(st.none(), st.sampled_from(["x", "y", "z"])))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=40))
def test_dedupe_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k1 string, k2 int, v1 int, v2 string")
    got = sorted(tuple(r) for r in S.dedupe(df, ["k1", "k2"]).collect())
    # brute force: per key, the smallest row under (v1, v2) ascending with NULLs first
    pdf = pd.DataFrame(rows, columns=["k1", "k2", "v1", "v2"])
    want = []
    for (k1, k2), g in pdf.groupby(["k1", "k2"], dropna=False):
        best = min(((v1 is not None and v1 == v1, v1 if v1 == v1 else None,
                     v2 is not None, v2) for v1, v2 in zip(g.v1.astype(object), g.v2)),
                   key=lambda t: (t[0], t[1] if t[0] else 0, t[2], t[3] if t[2] else ""))
        want.append((k1, int(k2), int(best[1]) if best[0] else None, best[3] if best[2] else None))
    assert got == sorted(want)
    # the result is unique in its keys
    assert len({(r[0], r[1]) for r in got}) == len(got)
