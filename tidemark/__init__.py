"""tidemark: subscription-service analytics as PySpark DataFrame functions."""
