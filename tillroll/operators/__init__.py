"""Distributed building blocks that several plans share."""
