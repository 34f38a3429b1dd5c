"""geoweave.plans"""
