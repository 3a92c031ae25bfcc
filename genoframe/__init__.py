"""genoframe: population-genomics analytics as Spark DataFrame plans.

Every operator is a plain function ``DataFrame -> DataFrame`` (keyword
parameters default to the reference constants).  Sub-packages:

* ``sources``   - readers, writers and the synthetic fixture views (A*)
* ``functions`` - column expressions: genotype parsing, contig order, IUPAC codes
* ``operators`` - variant (B), interval (C), divergent (D), haplotype (E),
                  alignment (F) and PCA / relatedness (G) operators
* ``plans``     - the query catalogue wired into ``__spark_entry__.py``
* ``streaming`` - incremental ingestion of per-strain mask files
"""

__version__ = "0.1.0"
