"""lawloom: a PySpark-native engine for turning hierarchical markup into keyed, validated tables."""
