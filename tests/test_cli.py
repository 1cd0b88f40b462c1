"""The command line runs the co-rated program end to end in its own JVM."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_corated_and_metadata():
    d = tempfile.mkdtemp(prefix="tg-cli-")
    ratings = os.path.join(d, "ratings.txt")
    titles = os.path.join(d, "titles.txt")
    rows = [(u, p, 1 + (u * 7 + p * 3) % 5) for u in range(12) for p in range(10) if (u + p) % 3]
    with open(ratings, "w") as f:
        f.writelines(f"{u}|{p}|{r}|{1400000000 + u}\n" for u, p, r in rows)
        f.write("x|1|5|1400000000\n")  # no user of that name
    with open(titles, "w") as f:
        f.writelines(f"{p}#Product {p}\n" for p in range(10))
    out = os.path.join(d, "out")
    env = dict(os.environ, PYTHONPATH=ROOT)
    res = subprocess.run([sys.executable, "-m", "tastegraph.cli", "--master", "local[2]", "--out", out,
                          "corated", ratings, titles, "1"], cwd=ROOT, env=env, capture_output=True, text=True,
                         timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    import pyarrow.parquet as pq
    t = pq.read_table(os.path.join(out, "recommendations")).to_pylist()
    assert t and all(r["user_id"] == 1 for r in t)
    seen = {p for u, p, _ in rows if u == 1}
    assert not seen & {r["product_id"] for r in t}
    assert pq.read_table(os.path.join(out, "rating_rejects")).num_rows == 1
    assert pq.read_table(os.path.join(out, "title_rejects")).num_rows == 0


def test_cli_encode_then_als_serves_id_0():
    """Encoded ids start at 0, and so may the profile's: it is served under another id."""
    d = tempfile.mkdtemp(prefix="tg-cli-")
    raw, meta, profile, out = (os.path.join(d, n) for n in ("raw.csv", "meta.json", "profile.txt", "out"))
    with open(raw, "w") as f:
        f.write("user_id,product_id,rating,ts\n")
        f.writelines(f"U{u},P{p},{1 + (u * 7 + p * 3) % 5},{1400000000 + 100 * (u + p)}\n" for u in range(15) for p in range(12))
    with open(meta, "w") as f:
        f.writelines(f"{{'asin': 'P{p}', 'title': 'Product {p}'}}\n" for p in range(14))
    with open(profile, "w") as f:
        f.writelines(f"0|{p}|{r}|1400000000|x\n" for p, r in ((1, 5), (3, 2), (4, 0)))
    env = dict(os.environ, PYTHONPATH=ROOT)

    def run(*args):
        return subprocess.run([sys.executable, "-m", "tastegraph.cli", "--master", "local[2]", "--out", out, *args], cwd=ROOT, env=env,
                              capture_output=True, text=True, timeout=600)

    res = run("encode", raw, "--metadata", meta)
    assert res.returncode == 0, res.stderr[-2000:]
    als = ["als", f"{out}/ratings.txt", f"{out}/titles.txt", profile, "--ranks", "2", "--lambdas", "0.1", "--iterations", "2"]
    assert "already present" in run(*als).stderr
    res = run(*als, "--serve-as", "1000000")
    assert res.returncode == 0, res.stderr[-2000:]
    import pyarrow.parquet as pq
    got = pq.read_table(f"{out}/recommendations").to_pylist()
    assert got and all(r["user_id"] == 1000000 and r["product_id"] not in (1, 3) for r in got)
