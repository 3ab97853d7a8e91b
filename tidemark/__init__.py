"""Incremental warehouse loads as plain PySpark DataFrame functions.

``operators`` and ``functions`` are pure (DataFrame in, DataFrame out, nothing runs),
``sources`` touches storage, ``plans`` puts both together into restartable loads.
"""
