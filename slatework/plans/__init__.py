"""Composed jobs: game tables, spine, feature views, mart, boards, model."""
