"""tessera: a PySpark-native engine for address-register data and training-data preparation."""
