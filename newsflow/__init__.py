"""newsflow: a PySpark-native engine for building and curating news corpora."""
