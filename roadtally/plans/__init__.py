"""Pipelines that chain operators: cleaning, integration, derived tables, materialised answers."""
