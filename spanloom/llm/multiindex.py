"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

A signature of PLACES values of b bits is cut into chunks. If two signatures differ in at most ``radius`` places, the errors allowed in the
chunks add up to so much that some chunk keeps within its own: with c chunks that allow t errors each, c * (t + 1) > radius. For
every chunk and every choice of t places in it the signature has a key, the other places' values: it stands for all values that the chosen
places may have, so all errors that a chunk allows are enumerated on both sides, and two signatures within the radius share a key. Nothing else
is left to chance than the signatures themselves.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .nearcopies import LEAST, PLACES, RADIUS, Scheme, components, prints

WIDTH = 2
#: Errors that each chunk allows.
ERRORS = 1


def chunks(radius: int = RADIUS, errors: int = ERRORS) -> list[range]:
    """The places of each chunk: the fewest chunks, as even as can be, of which one keeps within ``errors`` where a signature does within ``radius``."""
    n = radius // (errors + 1) + 1
    edges = [round(PLACES * k / n) for k in range(n + 1)]
    return [range(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def chunk_places(radius: int = RADIUS, errors: int = ERRORS) -> tuple[tuple[int, ...], ...]:
    """The keys' places: for each chunk and each choice of ``errors`` of its places the others."""
    return tuple(kept for places in chunks(radius, errors) for kept in combinations(places, len(places) - errors))


def minhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    A text's set is that of its distinct ``width``-word shingles, A-Z lower-cased; with fewer words it is the whole sequence. Texts link if
    what their sets share is at least ``least`` of their union, counted on the whole sets; component_id is the smallest doc_id reachable,
    the row's own included, and kept says that it is the row's own. A pair at 0.8 isn't found with a chance of 0.000014, that of its
    signatures differing in more places than the radius; a more alike one is still likelier found.

    Null and wordless texts have empty sets and link with nothing, not even with one another. Repeated rows are linked rows of their own, and
    so are rows that share an id. Rows without an id link like any other, and have a null component_id only if nothing else is reached; such
    a row is kept only then. An empty table gives an empty result; other columns are ignored.
    """
    scheme = Scheme(width, chunk_places(), least)
    rows = stored(prints(docs, scheme, id_col, text_col), "prints")
    found = components(docs, rows, scheme, id_col, text_col)
    own = found.withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return own.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
