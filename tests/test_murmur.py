"""The 64-bit hash over Arrow batches against the same hash in Python's integers."""

from pyspark.sql import functions as F

from changeloom.operators import routing as G

M = (1 << 64) - 1


def turned(x, n):
    return (x << n | x >> (64 - n)) & M


def by_definition(data: bytes) -> int:
    h, c = [x ^ G.SEED for x in G.HALVES], list(G.MULTIPLIERS)

    def block(k1, k2):
        h[0] = (h[0] ^ turned(k1 * c[0] & M, 23) * c[1] & M) + h[1] & M
        h[1] = (turned(h[1], 41) ^ turned(k2 * c[1] & M, 23) * c[0] & M) + h[0] & M
        h[:] = [(x * 3 + s) & M for x, s in zip(h, G.HALF_STEPS)]
        c[:] = [(x * 5 + s) & M for x, s in zip(c, G.MULTIPLIER_STEPS)]

    full = len(data) // 16 * 16
    for i in range(0, full, 16):
        block(int.from_bytes(data[i : i + 8], "little"), int.from_bytes(data[i + 8 : i + 16], "little"))
    k = [0, 0]
    for j, b in enumerate(data[full:]):
        k[j // 8] ^= ((b - 256 if b > 127 else b) << j % 8 * 8) & M
    if data[full:]:
        block(*k)
    h[1] ^= len(data)
    h[0] = h[0] + h[1] & M
    h[1] = h[1] + h[0] & M
    for i in (0, 1):
        for f in G.FINISH:
            h[i] = (h[i] ^ h[i] >> 33) * f & M
        h[i] ^= h[i] >> 33
    high = (h[0] + h[1] & M) >> 32
    return high - (1 << 32) if high >> 31 else high


def test_every_length_and_wrapping(spark):
    data = [bytes((i * 37 + n * 11) % 256 for i in range(n)) for n in range(41)] + [b"\xff" * 33, b"\x80" * 16, bytes(1000)]
    got = spark.createDataFrame([(bytearray(d),) for d in data], "b binary").select("b", G.murmur3(F.col("b"), "binary").alias("h")).collect()
    assert {bytes(r.b): r.h for r in got} == {d: by_definition(d) for d in data}
    texts = ["", "a", "größe", "a😀b" * 9, "x" * 31]
    got = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", G.murmur3(F.col("t"), "string").alias("h")).collect()
    assert {r.t: r.h for r in got} == {t: by_definition(t.encode()) for t in texts} | {None: None}
    numbers = [0, 1, -1, 127, 128, 1 << 31, (1 << 63) - 1, -(1 << 63)]
    got = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", G.murmur3(F.col("n"), "bigint").alias("h")).collect()
    fold = lambda n: (n ^ (n & M) >> 32) & 0xFFFFFFFF
    assert {r.n: r.h for r in got} == {n: by_definition(fold(n).to_bytes(4, "little")) for n in numbers}


def test_partition_of_an_order(spark):
    e = spark.sql("select 'c' as op, named_struct('id', 1L, 'product', 'orange') as after, cast(null as struct<id: bigint, product: string>) as before")
    assert G.to_partition(e, ["change.id", "change.product"], 100, "murmur").first().partition == 65
