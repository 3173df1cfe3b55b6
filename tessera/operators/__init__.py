"""DataFrame-in / DataFrame-out operators.

* ``text``       — tokenising, stop words, word counts, top / rare words
* ``split``      — random and key-hash splits, k folds
* ``features``   — string / vector indexing, assembly, label decoding
* ``evaluate``   — grouped regression metrics, accuracy, exact AUC
* ``supervised`` — trees, logistic regression, GLMs, summaries, reports
* ``tuning``     — parameter grids, cross-validation, CV reports
* ``linalg``     — long form, transpose, PCA, SVD, projection
* ``cluster``    — k-means and its report tables
* ``recommend``  — ALS fit, scoring, factor maps
"""
