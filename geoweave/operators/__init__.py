"""geoweave.operators"""
