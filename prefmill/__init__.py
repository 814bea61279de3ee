"""prefmill: a Spark-native engine for conversational training and preference data."""
