"""lotledger.plans"""
