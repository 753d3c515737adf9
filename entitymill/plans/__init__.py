"""Registered queries; importing the package fills the registry."""
