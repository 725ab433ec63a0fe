"""sylvan: a PySpark-native engine for weighted criteria trees and the document pipeline around them."""
