"""Credit-risk table operators, statistics and scoring as PySpark jobs.

Layout
------
functions   column expressions and tail probabilities
operators   DataFrame-in / DataFrame-out operators, fitted transforms, models
sources     readers, writers, model and trial storage
streaming   continuous scoring
plans       end-to-end flows and the registered queries
"""
