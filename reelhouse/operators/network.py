"""Persons who are connected by shared titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.session import checkpointed


def persons_within(credits: DataFrame, start: DataFrame, steps: int, shared: tuple[str, ...] = ("platform", "id")) -> DataFrame:
    """(person_id, step): persons reached from those of `start` over at most `steps` shared titles, by the fewest.

    `start` has a column person_id; those persons have step 0, if they have a credit or not. Nulls connect nothing.

    A breadth-first search with two visited sets. Each step goes from the persons reached last to titles that no step has met, and
    from these to persons that no step has met. So every credit is followed once in each direction at most, and
    a title that a third of all persons share is opened once and not once for each path to it. Recursive SQL
    keeps repeated rows of all steps (UNION ALL), whose number grows with the number of paths.
    """
    links = checkpointed(
        credits.select(F.col("person_ID").alias("person_id"), *shared).dropna().distinct()
    )
    last = checkpointed(start.select("person_id").dropna().distinct().withColumn("step", F.lit(0)))
    reached, met = last, links.select(*shared).limit(0)
    for step in range(1, steps + 1):
        titles = checkpointed(
            links.join(last.select("person_id"), "person_id").select(*shared).distinct().join(met, list(shared), "left_anti")
        )
        persons = links.join(titles, list(shared)).select("person_id").distinct()
        last = checkpointed(persons.join(reached, "person_id", "left_anti").withColumn("step", F.lit(step)))
        if last.isEmpty():
            break
        reached, met = checkpointed(reached.unionByName(last)), checkpointed(met.unionByName(titles))
    return reached
