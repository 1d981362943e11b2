"""Problem 8: filling containers of fixed capacity by multiway differencing."""

from __future__ import annotations

import heapq
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.llm.tokens import count_tokens
from quernel.session import cut

#: Containers a group is packed into, and the most items of a group: what one task gets is bounded by both.
GROUP_CONTAINERS, GROUP_ITEMS = 1024, 32_000


def differences(sizes: np.ndarray, k: int) -> np.ndarray:
    """The part (0 to k-1) of each item by multiway differencing: the two partial partitions with the largest spread
    are merged, the fullest parts of one with the emptiest of the other, until one is left."""
    n = len(sizes)
    left, right = [], []  # children of inner nodes; node i < n is item i, node n + j is the j-th inner one
    tick = count()
    heap = []
    for i in range(n):
        # an item alone: one part holds it, k - 1 are empty; sums and nodes ascending by sum
        heap.append((-int(sizes[i]), next(tick), np.array([int(sizes[i])]), np.array([i])))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, sums_a, nodes_a = heapq.heappop(heap)
        _, _, sums_b, nodes_b = heapq.heappop(heap)
        # parts that aren't listed are empty: a's fullest meet b's emptiest
        extra = len(sums_a) + len(sums_b) - k
        if extra <= 0:
            sums, nodes = np.concatenate([sums_a, sums_b]), np.concatenate([nodes_a, nodes_b])
        else:
            low_a, low_b = sums_a[:extra], sums_b[:extra][::-1]
            merged = np.arange(n + len(left), n + len(left) + extra)
            left += nodes_a[:extra].tolist()
            right += nodes_b[:extra][::-1].tolist()
            sums = np.concatenate([low_a + low_b, sums_a[extra:], sums_b[extra:]])
            nodes = np.concatenate([merged, nodes_a[extra:], nodes_b[extra:]])
        order = np.argsort(sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        if len(sums) == k and sums[0] > 0:
            base = sums[0]
            spread = sums - base
            # only differences matter from here on; the least part stays listed with 0
            sums = spread
        heapq.heappush(heap, (-int(sums[-1] - (sums[0] if len(sums) == k else 0)), next(tick), sums, nodes))
    part = np.zeros(n, dtype=np.int64)
    for p, node in enumerate(heap[0][3] if heap else []):
        stack = [int(node)]
        while stack:
            x = stack.pop()
            if x < n:
                part[x] = p
            else:
                stack += (left[x - n], right[x - n])
    return part


def settle(part: np.ndarray, sizes: np.ndarray, k: int, capacity: int) -> np.ndarray:
    """``part`` with items moved or exchanged until no part holds more than ``capacity``; items that had to leave are -1.

    Differencing leaves all parts nearly equal, a little over or under the capacity. Each overfull part gives one item to a
    roomy part, or for a smaller one of it, such that it fits and the other doesn't overflow. Where no roomy part allows
    that, the least item that is large enough leaves.
    """
    part = part.copy()
    held = np.bincount(part, sizes, minlength=k).astype(np.int64)
    order = np.argsort(part, kind="stable")
    members = [list(x) for x in np.split(order, np.cumsum(np.bincount(part, minlength=k))[:-1])]
    roomy = [(int(h) - capacity, p) for p, h in enumerate(held) if h < capacity]  # most room first
    heapq.heapify(roomy)
    for over in np.flatnonzero(held > capacity):
        aside = []
        while roomy and (excess := int(held[over]) - capacity) > 0:
            negative, p = heapq.heappop(roomy)
            room = -negative
            give, take = sizes[members[over]], np.append(sizes[members[p]], 0)
            gain = give[:, None] - take[None, :]
            fit = (gain > 0) & (gain <= room)
            if not fit.any():
                aside.append((negative, p))
                continue
            enough = fit & (gain >= excess)
            pick = np.where(enough, gain, np.iinfo(np.int64).max).argmin() if enough.any() else np.where(fit, gain, -1).argmax()
            i, j = divmod(int(pick), gain.shape[1])
            moved = int(gain[i, j])
            item = members[over].pop(i)
            if j < len(members[p]):
                back = members[p].pop(j)
                members[over].append(back)
                part[back] = over
            members[p].append(item)
            part[item] = p
            held[over] -= moved
            held[p] += moved
            if moved < room:
                aside.append((moved - room, p))
        while held[over] > capacity:
            own = sizes[members[over]]
            wide = own >= held[over] - capacity
            item = members[over].pop(int(np.where(wide, own, np.iinfo(np.int64).max).argmin() if wide.any() else own.argmax()))
            part[item] = -1
            held[over] -= sizes[item]
        if held[over] < capacity:
            aside.append((int(held[over]) - capacity, over))
        for x in aside:
            heapq.heappush(roomy, x)
    for item in sorted(np.flatnonzero(part < 0), key=lambda i: -sizes[i]):  # some have room elsewhere by now
        if roomy and -roomy[0][0] >= sizes[item]:
            negative, p = heapq.heappop(roomy)
            part[item] = p
            if negative + sizes[item] < 0:
                heapq.heappush(roomy, (negative + int(sizes[item]), p))
    return part


def windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """A container number for each item, none over ``capacity``; sizes are at most that. The number of containers begins at
    the least possible; what doesn't fit goes into further ones, or the number rises and all begins anew where that
    takes fewer. Items of size 0 go into container 0."""
    out = np.zeros(len(sizes), dtype=np.int64)
    held = np.flatnonzero(sizes > 0)
    own = sizes[held]
    if not len(own):
        return out
    k = max(1, -(-int(own.sum()) // capacity), int((own * 2 > capacity).sum()))
    best = None
    while best is None or k < best.max() + 1:
        part = settle(differences(own, k), own, k, capacity)
        left = part < 0
        if left.any():
            part[left] = k + (windows(own[left], capacity) if left.sum() < len(own) else np.arange(left.sum()))
        used = int(part.max()) + 1
        if best is None or used < best.max() + 1:
            best = part
        k += max(1, (used - k) // 2)
    out[held] = best
    return out


def containers(documents: DataFrame, capacity: int, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(container_id, doc_id, part_no, first_token, tokens) - every document's place in containers of ``capacity`` tokens.

    A document above the capacity is cut into full containers of its own and a rest, which is packed like a whole
    document; all others stay whole. Documents are dealt to groups of about ``GROUP_CONTAINERS`` containers and at
    most about ``GROUP_ITEMS`` documents by a hash that also tells equal rows apart, so no group grows with the data;
    each group is packed by multiway differencing. One without tokens (null, empty) takes no room in its group's
    first container. Repeated rows are packed each; a null doc_id is kept.
    """
    sizes = cut(count_tokens(documents, doc_id, text, path).withColumn("salt", F.xxhash64(F.spark_partition_id(), "place", "doc_id")).drop("place"))
    full = F.floor(F.col("tokens") / capacity).cast("int")
    # exactly full documents and full pieces need no packing
    pieces = sizes.withColumn("full", F.when(F.col("tokens") > capacity, full).otherwise((F.col("tokens") == capacity).cast("int")))
    whole = pieces.where("full > 0").select("doc_id", "salt", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("part_no"))
    whole = whole.select(
        F.concat_ws("-", F.lit("f"), F.hex("salt"), "part_no").alias("container_id"), "doc_id", "part_no", (F.col("part_no").cast("long") * capacity).alias("first_token"), F.lit(capacity).cast("long").alias("tokens")
    )
    rest = pieces.select("doc_id", "salt", F.col("full").alias("part_no"), (F.col("full").cast("long") * capacity).alias("first_token"), (F.col("tokens") - F.col("full") * capacity).alias("tokens"))
    rest = rest.where((F.col("tokens") > 0) | (F.col("part_no") == 0))
    total = rest.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("n")).first()
    groups = max(1, round(total.t / (capacity * GROUP_CONTAINERS)), -(-total.n // GROUP_ITEMS))
    kind = dict(rest.dtypes)["doc_id"]

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["tokens", "salt"], ascending=False)
        part = windows(group["tokens"].to_numpy(dtype=np.int64), capacity)
        return pd.DataFrame({"container_id": [f"g-{key[0]}-{p}" for p in part], **{c: group[c] for c in ("doc_id", "part_no", "first_token", "tokens")}})

    packed = rest.withColumn("grp", F.pmod("salt", F.lit(groups))).groupBy("grp").applyInPandas(pack, f"container_id string, doc_id {kind}, part_no int, first_token long, tokens long")
    return packed.unionByName(whole)


def fill(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers in use, tokens, the least containers any packing needs, and the share of room used."""
    per = packed.groupBy("container_id").agg(F.sum("tokens").alias("used")).where("used > 0")
    return per.agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"), F.ceil(F.sum("used") / capacity).alias("least"), F.round(F.sum("used") / (F.count(F.lit(1)) * capacity), 6).alias("used_share"))
