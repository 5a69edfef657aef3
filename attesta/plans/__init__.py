"""Bound queries; importing this package fills the catalogue."""
