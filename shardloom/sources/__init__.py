"""Inputs that become ``(_id, source)`` documents."""
