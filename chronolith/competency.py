"""Named competency views and question families, one statement each, for Spark SQL and DuckDB alike.

Parameters of a view (a member, a term, a date) are its feature and stand in its statement; everything else
covers whole tables. Interval ends are inclusive, a null end is open; "current" is judged on ``AS_OF``.
"""

from __future__ import annotations

from chronolith.model import AS_OF

IN_FORCE = f"s <= {AS_OF} AND (e IS NULL OR {AS_OF} <= e)"
FOREVER = "DATE '9999-12-31'"

STATEMENTS: dict[str, str] = {
    # scans and projections
    "s12_construct_graph": """
        SELECT DISTINCT concat('urn:x:member/', CAST(member AS STRING)) AS s, p, o
        FROM (SELECT member, 'name' AS p, name AS o FROM members
              UNION ALL SELECT member, 'home', CAST(home AS STRING) FROM members
              UNION ALL SELECT member, 'code', code FROM members) t""",
    "s15_month_windows": """
        SELECT CAST(date_trunc('month', day) AS DATE) AS first_day, last_day(day) AS last_day,
               count(*) AS n, count(DISTINCT record) AS records
        FROM sittings GROUP BY date_trunc('month', day), last_day(day)""",
    "p06_route_regex": """
        SELECT page_id, regexp_extract(url, '^https?://[^/]+/([a-z]+)/[0-9]+', 1) AS chamber
        FROM pages WHERE regexp_extract(url, '^https?://[^/]+/([a-z]+)/[0-9]+', 1) <> ''""",
    "p10_folded_equality": """
        SELECT a.concept, b.concept AS other FROM concepts a JOIN concepts b
        ON lower(trim(a.label)) = lower(trim(b.label)) AND a.concept < b.concept""",
    "p13_built_identifiers": """
        SELECT DISTINCT concat('urn:x:bill/', CAST(bill AS STRING), '#process') AS process,
               concat('urn:x:bill/', CAST(bill AS STRING), '#stage-', CAST(stage_no AS STRING)) AS stage
        FROM activities""",
    # joins
    "j04_nested_optional": """
        SELECT m.member, c.line, c.s AS started, c.e AS ended,
               CASE WHEN c.s IS NULL THEN 'no range' WHEN c.e IS NULL THEN 'open' ELSE 'closed' END AS state
        FROM members m LEFT JOIN committee_memberships c ON c.member = m.member AND c.committee = 3""",
    "j05_optional_across_owners": """
        SELECT c.member, c.committee, k.name AS committee_name, m.name AS member_name,
               CASE WHEN k.name IS NULL AND m.name IS NULL THEN 'both' WHEN k.name IS NULL THEN 'committee'
                    WHEN m.name IS NULL THEN 'member' ELSE 'none' END AS missing
        FROM (SELECT DISTINCT member, committee FROM committee_memberships WHERE s >= DATE '2001-01-01') c
        LEFT JOIN committees k ON k.committee = c.committee LEFT JOIN members m ON m.member = c.member""",
    "j15_kernel_binding": f"""
        SELECT r.member, r.id AS membership, r.constituency, p.party, k.committee
        FROM (SELECT * FROM memberships WHERE {IN_FORCE}) r
        JOIN (SELECT id, member, party FROM memberships WHERE ps <= {AS_OF} AND (pe IS NULL OR {AS_OF} <= pe)) p
          ON p.member = r.member AND p.id = r.id
        JOIN (SELECT DISTINCT member, committee FROM committee_memberships WHERE {IN_FORCE}) k ON k.member = r.member""",
    "j16_minus_with_built_keys": """
        SELECT DISTINCT concat('urn:x:supplier/', CAST(t.sponsor AS STRING)) AS target
        FROM (SELECT sponsor FROM participations UNION ALL SELECT sponsor + 1 FROM participations) t
        LEFT JOIN committees k
          ON concat('urn:x:supplier/', CAST(t.sponsor AS STRING)) = concat('urn:x:supplier/', CAST(k.committee AS STRING))
        WHERE k.committee IS NULL""",
    "j20_sponsor_path": """
        SELECT DISTINCT b.bill, b.bill_year, a.stage_no AS delivery, p.sponsor, k.name
        FROM bills b JOIN activities a ON a.bill = b.bill AND a.stage_no = 1
        JOIN participations p ON p.bill = a.bill AND p.is_primary JOIN committees k ON k.committee = p.sponsor
        WHERE b.status = 'P'""",
    # aggregates
    "a06_class_counts": """
        SELECT class, count(DISTINCT id) AS n FROM (
            SELECT 'Member' AS class, member AS id FROM members UNION ALL SELECT 'Bill', bill FROM bills
            UNION ALL SELECT 'Membership', id FROM memberships UNION ALL SELECT 'Committee', committee FROM committees
            UNION ALL SELECT 'Concept', concept FROM concepts) t GROUP BY class ORDER BY n DESC, class""",
    "a07_identity_terms": """
        SELECT m.member, max(n.name) AS name, count(DISTINCT m.term_no) AS terms
        FROM memberships m LEFT JOIN members n ON n.member = m.member GROUP BY m.member""",
    "a08_distinct_members": """
        SELECT member, min(name) AS name FROM (
            SELECT n.member, lower(n.name) AS name FROM members n JOIN committee_memberships c ON c.member = n.member
            UNION ALL SELECT n.member, n.name FROM members n JOIN office_holdings o ON o.member = n.member) t
        GROUP BY member""",
    "a13_published_by_year": """
        SELECT y AS published_year, count(DISTINCT bill) AS bills, sum(undated) AS undated FROM (
            SELECT bill, CAST(year(min(activity_date)) AS INT) AS y,
                   max(CASE WHEN activity_date IS NULL THEN 1 ELSE 0 END) AS undated
            FROM activities WHERE activity_type = 'N' GROUP BY bill) t GROUP BY y""",
    "a14_interval_conflicts": """
        SELECT member, committee, count(*) AS n, count(DISTINCT s) AS starts, count(DISTINCT coalesce(e, DATE '9999-12-31')) AS ends
        FROM (SELECT DISTINCT member, committee, s, e FROM committee_memberships) t
        GROUP BY member, committee HAVING count(*) > 1""",
    "a18_names_by_language": """
        SELECT owner, lang, CASE WHEN count(DISTINCT lower(trim(label))) > 1 THEN NULL ELSE min(label) END AS label,
               CASE WHEN count(DISTINCT lower(trim(label))) > 1 THEN 'ambiguous' ELSE 'chosen' END AS status
        FROM (SELECT owner, lang, label, rank() OVER (PARTITION BY owner, lang
                     ORDER BY CASE WHEN e IS NULL THEN 0 ELSE 1 END, s DESC) AS place
              FROM (SELECT member AS owner, CASE WHEN term_no % 2 = 0 THEN 'en' ELSE 'ga' END AS lang, party AS label, s, e
                    FROM memberships) t) u
        WHERE place = 1 GROUP BY owner, lang""",
    "a20_run_summaries": """
        SELECT CAST(observed_at AS DATE) AS run, count(*) AS seen, count(DISTINCT resource) AS resources,
               sum(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) AS failed,
               sum(CASE WHEN kind <> 'error' THEN 1 ELSE 0 END) AS succeeded
        FROM observations GROUP BY CAST(observed_at AS DATE)""",
    "a22_stratified_estimate": """
        SELECT bin, count(*) AS n, sum(n_chars) AS chars, CAST(median(words) AS DOUBLE) AS median_words,
               CAST(median(words) AS DOUBLE) * count(*) AS estimate
        FROM (SELECT n_chars, length(text) - length(replace(text, ' ', '')) + 1 AS words,
                     least(9, CAST(floor(log2(greatest(n_chars, 1)) - 4) AS INT)) AS bin
              FROM documents WHERE text IS NOT NULL) t GROUP BY bin""",
    "a25_latency_by_stage": """
        SELECT kind AS stage, count(value) AS n, round(CAST(median(value) AS DOUBLE), 6) AS median_value, max(value) AS max_value
        FROM observations GROUP BY kind""",
    # windows, order, sets
    "w04_latest_term_of_member": """
        SELECT member, term_no, s FROM (
            SELECT member, term_no, s, dense_rank() OVER (PARTITION BY member ORDER BY s DESC) AS place,
                   count(*) OVER (PARTITION BY member, s) AS same FROM services WHERE house = 'dail') t
        WHERE place = 1 AND same = 1""",
    "w08_stage_chronology": """
        SELECT bill, stage_no, activity_date,
               CAST(row_number() OVER (PARTITION BY bill ORDER BY activity_date, stage_no, activity_type) AS BIGINT) AS place
        FROM activities""",
    "o05_folded_sort": "SELECT lower(name) AS shown, committee FROM committees ORDER BY lower(name), committee",
    "u02_several_works": """
        SELECT 'speech' AS work, record, count(*) AS n FROM components WHERE kind = 'user' GROUP BY record
        UNION ALL SELECT 'answer', record, count(*) FROM components WHERE kind = 'assistant' GROUP BY record
        UNION ALL SELECT 'notice', record, count(*) FROM components WHERE kind NOT IN ('user', 'assistant') GROUP BY record""",
    "u03_typed_branches": """
        SELECT id, member, party AS label, 'party' AS branch FROM memberships WHERE party <> '5-LOW'
        UNION ALL SELECT id, member, 'Independent', 'independent' FROM memberships WHERE party = '5-LOW'""",
    "u07_stale_graphs": """
        SELECT DISTINCT old.bill AS stale FROM activities old
        LEFT JOIN bills now ON now.bill = old.bill AND now.status <> 'F' WHERE now.bill IS NULL""",
    "u08_two_endpoints": """
        SELECT sponsor AS identity, min(name) AS name,
               CASE WHEN count(DISTINCT name) > 1 THEN 'conflict' ELSE 'same' END AS status
        FROM (SELECT committee AS sponsor, name FROM committees
              UNION ALL SELECT committee, CASE WHEN committee % 5 = 0 THEN concat(name, ' (old)') ELSE name END
              FROM committees) t GROUP BY sponsor""",
    # scalar functions
    "f08_paths": """
        SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host,
               concat('/', split_part(split_part(url, '://', 2), '/', 2)) AS head, split_part(url, '?', 1) AS bare
        FROM pages""",
    "f10_string_tests": """
        SELECT page_id, CAST(length(url) AS BIGINT) AS n, url LIKE '%feed' AS ends, replace(url, 'http://', 'https://') AS safe,
               regexp_replace(url, '[?].*$', '') AS bare FROM pages""",
    "f16_month_window": """
        SELECT DISTINCT CAST(date_trunc('month', day) AS DATE) AS first_day, last_day(day) AS last_day,
               CAST(day(last_day(day)) AS INT) AS days FROM sittings""",
    "f17_ordinals": """
        SELECT term_no, concat(CAST(term_no AS STRING), CASE WHEN term_no % 100 IN (11, 12, 13) THEN 'th'
               WHEN term_no % 10 = 1 THEN 'st' WHEN term_no % 10 = 2 THEN 'nd' WHEN term_no % 10 = 3 THEN 'rd' ELSE 'th' END) AS ordinal
        FROM (SELECT DISTINCT CAST(size + 0 AS INT) AS term_no FROM (SELECT p_size AS size FROM part) t) u""",
    # resolution in context
    "e03_term_context": f"""
        SELECT label, term_no, count(DISTINCT member) AS candidates,
               CASE WHEN count(DISTINCT member) = 1 THEN 'resolved' WHEN count(DISTINCT member) >= 100 THEN 'refused' ELSE 'ambiguous' END AS status,
               CASE WHEN count(DISTINCT member) = 1 THEN min(member) END AS member
        FROM (SELECT n.code AS label, m.term_no, m.member FROM members n JOIN memberships m ON m.member = n.member) t
        GROUP BY label, term_no""",
    "e06_member_clues": """
        SELECT n.member, n.name, m.party, m.constituency, k.name AS constituency_name, m.term_no
        FROM members n JOIN memberships m ON m.member = n.member
        JOIN constituencies k ON k.constituency = m.constituency""",
    "e08_term_affiliations": """
        SELECT term_no, label, count(DISTINCT party) AS candidates, min(party) AS party,
               CASE WHEN count(DISTINCT party) = 1 THEN 'resolved' ELSE 'ambiguous' END AS status
        FROM (SELECT DISTINCT term_no, party, lower(party) AS label FROM memberships
              UNION ALL SELECT DISTINCT term_no, party, lower(substring(party, 3, 20)) FROM memberships
              UNION ALL SELECT DISTINCT term_no, party, substring(party, 1, 1) FROM memberships WHERE term_no > 2) t
        GROUP BY term_no, label""",
    "e09_numbered_term": """
        SELECT house, term_no, count(DISTINCT term_no) AS candidates, min(s) AS first_start
        FROM services WHERE term_no = 3 GROUP BY house, term_no""",
    "e10_current_incarnation": f"""
        SELECT k.committee, k.name, count(DISTINCT c.member) AS members,
               CASE WHEN count(DISTINCT c.member) = 0 THEN 'unresolved' ELSE 'current' END AS status
        FROM committees k LEFT JOIN (SELECT * FROM committee_memberships WHERE {IN_FORCE}) c ON c.committee = k.committee
        GROUP BY k.committee, k.name""",
    "e11_constituency_in_term": """
        SELECT k.name, m.term_no, count(DISTINCT m.constituency) AS candidates, min(m.constituency) AS constituency
        FROM memberships m JOIN constituencies k ON k.constituency = m.constituency GROUP BY k.name, m.term_no""",
    "e12_place_suggestions": """
        SELECT h.name AS place, k.constituency, k.name AS suggestion FROM houses h
        JOIN constituencies k ON k.house = h.house""",
    # reconciliation
    "r03_party_candidates": """
        SELECT p.party, o.kind AS candidate, CASE WHEN p.last_end < o.first_year THEN 'historical conflict' ELSE 'candidate' END AS status
        FROM (SELECT party, max(coalesce(CAST(year(e) AS INT), 9999)) AS last_end FROM memberships GROUP BY party) p
        JOIN (SELECT kind, min(bill_year) AS first_year FROM bills GROUP BY kind) o ON lower(o.kind) = lower(p.party)""",
    "r04_negative_evidence": """
        SELECT k.committee, CASE WHEN count(DISTINCT m.member) = 0 THEN 'negative' WHEN count(DISTINCT m.member) = 1 THEN 'accepted' ELSE 'ambiguous' END AS status,
               count(DISTINCT m.member) AS candidates
        FROM committees k LEFT JOIN members m
          ON substring(m.name, 10, 9) = substring(k.name, 10, 9) AND m.home = k.code GROUP BY k.committee""",
    "r05_office_candidates": """
        SELECT h.id, h.office, h.office_type, count(a.office_type) AS aliases,
               CASE WHEN count(a.office_type) = 0 THEN 'no alias'
                    WHEN max(CASE WHEN a.first_start <= h.s THEN 1 ELSE 0 END) = 0 THEN 'validity conflict'
                    WHEN count(a.office_type) = 1 AND max(CASE WHEN a.cabinet = h.cabinet THEN 1 ELSE 0 END) = 1 THEN 'accepted'
                    ELSE 'review' END AS status
        FROM office_holdings h LEFT JOIN
             (SELECT office, office_type, cabinet, min(s) AS first_start FROM office_holdings WHERE cabinet GROUP BY office, office_type, cabinet) a
          ON a.office = h.office AND a.office_type = h.office_type GROUP BY h.id, h.office, h.office_type, h.s""",
    "r06_office_ledger": """
        SELECT office, office_type, min(s) AS first_seen, max(s) AS last_seen, count(*) AS occurrences,
               CASE WHEN max(CASE WHEN e IS NULL THEN 1 ELSE 0 END) = 1 THEN 'current' ELSE 'retained' END AS state
        FROM office_holdings GROUP BY office, office_type""",
    "r07_sponsor_candidates": """
        SELECT p.bill, p.sponsor, count(DISTINCT h.office) AS offices,
               CASE WHEN count(DISTINCT h.office) = 0 THEN 'no holding' WHEN count(DISTINCT h.office) = 1 THEN 'accepted' ELSE 'conflict' END AS status
        FROM (SELECT p.bill, p.sponsor, min(a.activity_date) AS day FROM participations p
              JOIN activities a ON a.bill = p.bill WHERE p.is_primary GROUP BY p.bill, p.sponsor) p
        LEFT JOIN office_holdings h ON h.member = p.sponsor AND h.s <= p.day AND (h.e IS NULL OR p.day <= h.e)
        GROUP BY p.bill, p.sponsor""",
    "r08_sponsor_ledger": """
        SELECT coalesce(n.bill, o.bill) AS bill, coalesce(n.sponsor, o.sponsor) AS sponsor,
               CASE WHEN o.bill IS NULL THEN 'new' WHEN n.bill IS NULL THEN 'revoked' ELSE 'retained' END AS state
        FROM (SELECT DISTINCT bill, sponsor FROM participations WHERE is_primary) n
        FULL OUTER JOIN (SELECT DISTINCT bill, sponsor FROM participations WHERE bill % 3 <> 0 AND (is_primary OR bill % 7 = 0)) o
          ON o.bill = n.bill AND o.sponsor = n.sponsor""",
    "r09_due": """
        SELECT resource, last_seen, CASE WHEN dirty = 1 THEN 'dirty' WHEN next_check <= TIMESTAMP '2024-01-20 00:00:00' THEN 'recheck' ELSE 'identity changed' END AS reason
        FROM (SELECT resource, max(observed_at) AS last_seen, max(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) AS dirty,
                     max(observed_at) + INTERVAL 7 DAY AS next_check, count(DISTINCT hash) AS hashes
              FROM observations GROUP BY resource) t
        WHERE dirty = 1 OR next_check <= TIMESTAMP '2024-01-20 00:00:00' OR hashes > 1""",
    "r11_affiliations": """
        SELECT t.party, t.term_no, d.identity, CASE WHEN d.identity IS NULL THEN 'undecided' ELSE 'decided' END AS state
        FROM (SELECT DISTINCT party, term_no FROM memberships) t
        LEFT JOIN (SELECT DISTINCT party, concat('affiliation/', substring(party, 1, 1)) AS identity FROM memberships WHERE party < '4') d
          ON d.party = t.party""",
    # validation
    "v02_envelope_counts": """
        SELECT r.record, r.advertised, coalesce(c.found, 0) AS found FROM
             (SELECT record, max(ordinal) AS advertised FROM components GROUP BY record) r
        LEFT JOIN (SELECT record, count(*) AS found FROM components WHERE text IS NOT NULL GROUP BY record) c
          ON c.record = r.record WHERE coalesce(c.found, 0) <> r.advertised""",
    "v06_quality": """
        SELECT 'party' AS kind, id AS resource, 'episode ends before it starts' AS problem FROM memberships WHERE pe < ps
        UNION ALL SELECT 'party', id, 'episode starts before membership' FROM memberships WHERE ps < s
        UNION ALL SELECT 'committee', id, 'membership ends before it starts' FROM committee_memberships WHERE e < s
        UNION ALL SELECT 'house', CAST(term_no AS BIGINT), 'no end and not the last' FROM house_terms
            WHERE e IS NULL AND term_no < (SELECT max(term_no) FROM house_terms)""",
    "v09_report_edges": """
        SELECT coalesce(a.bill, b.bill) AS bill, coalesce(a.n, 0) AS reported, coalesce(b.n, 0) AS linked
        FROM (SELECT bill, count(*) AS n FROM activities GROUP BY bill) a
        FULL OUTER JOIN (SELECT bill, count(DISTINCT sponsor) AS n FROM participations GROUP BY bill) b ON b.bill = a.bill
        WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""",
    "v10_foreign_descriptions": """
        SELECT DISTINCT c.member AS subject, 'committee' AS described_in FROM committee_memberships c
        LEFT JOIN members m ON m.member = c.member AND m.home <> 3 WHERE m.member IS NULL""",
    "v11_vocabulary": """
        SELECT used.term, used.n FROM (SELECT activity_type AS term, count(*) AS n FROM activities GROUP BY activity_type
              UNION ALL SELECT status, count(*) FROM bills GROUP BY status) used
        LEFT JOIN (SELECT 'R' AS term UNION ALL SELECT 'A' UNION ALL SELECT 'F' UNION ALL SELECT 'O') pinned ON pinned.term = used.term
        WHERE pinned.term IS NULL""",
    "v12_office_registry": """
        SELECT office, 'several types' AS problem, count(DISTINCT office_type) AS n FROM office_holdings
        GROUP BY office HAVING count(DISTINCT office_type) > 1
        UNION ALL SELECT office, 'cabinet and not', count(DISTINCT cabinet) FROM office_holdings
        GROUP BY office HAVING count(DISTINCT cabinet) > 1""",
    "v13_sponsor_rederived": """
        SELECT bill, sponsor, 'only in one derivation' AS problem FROM (
            SELECT bill, sponsor FROM (SELECT DISTINCT bill, sponsor FROM participations WHERE is_primary
                UNION ALL SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_linenumber < 2) t
            GROUP BY bill, sponsor HAVING count(*) <> 2) u""",
    "v14_provenance": """
        SELECT resource, count(*) AS observations, count(DISTINCT hash) AS hashes, min(observed_at) AS first_seen, max(observed_at) AS last_seen,
               CASE WHEN count(*) = count(DISTINCT observed_at) THEN 'ordered' ELSE 'simultaneous' END AS status
        FROM observations GROUP BY resource""",
    # incremental
    "x08_log_order": """
        SELECT event_id, resource, CASE WHEN observed_at < before THEN 'out of order' ELSE 'same time' END AS problem FROM (
            SELECT event_id, resource, observed_at, lag(observed_at) OVER (PARTITION BY resource ORDER BY event_id) AS before
            FROM observations) t WHERE observed_at <= before""",
    "x10_pagination_drift": """
        WITH pages_seen AS (SELECT CAST(floor(event_id / 100.0) AS BIGINT) AS page, count(DISTINCT resource) AS n
                            FROM observations GROUP BY CAST(floor(event_id / 100.0) AS BIGINT))
        SELECT a.page, a.n, b.n AS before FROM pages_seen a JOIN pages_seen b ON b.page = a.page - 1 WHERE a.n <> b.n""",
    "x13_sessions": """
        SELECT resource, session, min(observed_at) AS first_at, max(observed_at) AS last_at, count(*) AS n FROM (
            SELECT resource, observed_at, sum(fresh) OVER (PARTITION BY resource ORDER BY observed_at, event_id ROWS UNBOUNDED PRECEDING) AS session
            FROM (SELECT resource, observed_at, event_id, CASE WHEN lag(observed_at) OVER (PARTITION BY resource ORDER BY observed_at, event_id)
                         + INTERVAL 6 HOUR >= observed_at THEN 0 ELSE 1 END AS fresh FROM observations) t) u
        GROUP BY resource, session""",
    # competency views
    "c02_open_seanad": "SELECT DISTINCT term_no FROM services WHERE house = 'seanad' AND e IS NULL",
    "c03_term_details": "SELECT house, term_no, min(s) AS first_start, max(e) AS last_end FROM services GROUP BY house, term_no",
    "c05_accountability": """
        SELECT h.name AS house, count(DISTINCT o.office) AS offices FROM houses h
        JOIN constituencies k ON k.house = h.house JOIN memberships m ON m.constituency = k.constituency
        JOIN office_holdings o ON o.member = m.member AND o.cabinet GROUP BY h.name""",
    "c07_members_of_term": "SELECT DISTINCT m.member, n.name FROM memberships m JOIN members n ON n.member = m.member WHERE m.term_no = 4",
    "c09_representation": """
        SELECT m.member, m.id, k.constituency, k.name, m.s, m.e FROM memberships m
        JOIN constituencies k ON k.constituency = m.constituency""",
    "c10_party_at": """
        SELECT id, member, party, ps, pe FROM memberships
        WHERE ps <= DATE '1998-04-01' AND (pe IS NULL OR DATE '1998-04-01' <= pe)""",
    "c11_two_parties": """
        SELECT t.party, t.term_no FROM (SELECT DISTINCT party, term_no FROM memberships WHERE party IN ('1-URGENT', '5-LOW')) t
        WHERE EXISTS (SELECT 1 FROM bills b WHERE b.kind = t.party AND b.status = 'P')
           OR EXISTS (SELECT 1 FROM office_holdings o JOIN memberships m ON m.member = o.member WHERE m.party = t.party)""",
    "c12_tuple_values": """
        SELECT v.class, v.kind, k.constituency, k.name FROM constituencies k
        JOIN (SELECT 1 AS id, 'Constituency' AS class, 'geographic' AS kind UNION ALL SELECT 7, 'Panel', 'vocational'
              UNION ALL SELECT 24, 'Panel', 'university') v ON v.id = k.constituency""",
    "c13_committee_labels": """
        SELECT e.committee, e.name AS label_en, g.label AS label_ga, e.kind
        FROM committees e LEFT JOIN (SELECT committee, concat('Coiste ', name) AS label FROM committees WHERE committee % 2 = 0) g
          ON g.committee = e.committee""",
    "c14_bill_status": """
        SELECT b.bill, b.status, a.stage_no AS latest_stage, a.activity_type, CASE WHEN b.status = 'F' THEN concat('act/', CAST(b.bill AS STRING)) END AS act
        FROM bills b LEFT JOIN (SELECT bill, stage_no, activity_type, row_number() OVER (PARTITION BY bill
             ORDER BY activity_date DESC, stage_no DESC, activity_type) AS place FROM activities) a ON a.bill = b.bill AND a.place = 1""",
    "c16_updated_since": """
        SELECT bill, max(activity_date) AS updated FROM activities GROUP BY bill HAVING max(activity_date) >= DATE '2001-06-01'""",
    "c17_records_on_day": """
        SELECT s.record, s.body, s.day, count(c.ordinal) AS parts FROM sittings s LEFT JOIN components c ON c.record = s.record
        WHERE s.body IN ('click', 'view') AND s.day = DATE '2024-01-05' GROUP BY s.record, s.body, s.day, s.sitting""",
    "c18_record_sitting": """
        SELECT c.record, s.body, s.day FROM (SELECT DISTINCT record FROM components) c
        LEFT JOIN (SELECT record, min(body) AS body, min(day) AS day FROM sittings GROUP BY record) s ON s.record = c.record""",
    "c21_question_recipients": """
        SELECT q.record, q.ordinal, a.ordinal AS answered_at, a.kind AS recipient FROM components q
        LEFT JOIN components a ON a.record = q.record AND a.ordinal = q.ordinal + 1 AND a.kind <> 'user' WHERE q.kind = 'user'""",
    "c22_divisions": """
        SELECT division, count(*) AS cast_votes, sum(CASE WHEN side = 'ta' THEN 1 ELSE 0 END) AS ta,
               sum(CASE WHEN side = 'nil' THEN 1 ELSE 0 END) AS nil, max(CASE WHEN member = 3 THEN side END) AS side_of_3,
               CASE WHEN sum(CASE WHEN side = 'ta' THEN 1 ELSE 0 END) > sum(CASE WHEN side = 'nil' THEN 1 ELSE 0 END) THEN 'carried' ELSE 'lost' END AS outcome
        FROM votes GROUP BY division""",
    "c23_office_holdings": """
        SELECT o.member, n.name, o.office, o.office_type, o.s, o.e FROM office_holdings o JOIN members n ON n.member = o.member
        WHERE o.member IN (SELECT member FROM members WHERE code = 'BUILDING')""",
    "c24_event_sections": """
        SELECT a.bill, concat('urn:x:bill/', CAST(a.bill AS STRING), '#event-', CAST(a.stage_no AS STRING)) AS event, c.record, c.ordinal
        FROM activities a JOIN components c ON c.record = a.bill AND c.ordinal = a.stage_no""",
    "c26_enduring_identities": """
        SELECT DISTINCT t.party, t.term_no, i.identity FROM memberships t
        JOIN (SELECT DISTINCT party, substring(party, 3, 20) AS identity FROM memberships) i ON i.party = t.party
        WHERE i.identity IN ('HIGH', 'MEDIUM', 'NOT SPECIFIED')""",
    "c30_parties_with_evidence": """
        SELECT term_no, constituency, party, count(*) AS episodes, min(ps) AS first_start, max(pe) AS last_end,
               sum(CASE WHEN pe IS NULL THEN 1 ELSE 0 END) AS open_episodes
        FROM memberships GROUP BY term_no, constituency, party""",
    "c31_duplicate_labels": """
        SELECT label, count(DISTINCT concept) AS identities, min(concept) AS first_concept FROM concepts
        GROUP BY label HAVING count(DISTINCT concept) > 1""",
    "c32_publication_checks": """
        SELECT 'houses' AS what, count(*) AS n, CASE WHEN count(*) = count(DISTINCT house) AND count(*) > 0 THEN 'pass' ELSE 'fail' END AS result FROM houses
        UNION ALL SELECT 'constituencies', count(*), CASE WHEN count(*) = count(DISTINCT constituency) THEN 'pass' ELSE 'fail' END FROM constituencies
        UNION ALL SELECT 'members', count(*), CASE WHEN count(*) = count(DISTINCT member) THEN 'pass' ELSE 'fail' END FROM members
        UNION ALL SELECT 'bills', count(*), CASE WHEN count(*) = count(DISTINCT bill) THEN 'pass' ELSE 'fail' END FROM bills""",
    # question families
    "q02_all_of_name": """
        SELECT n.code AS label, n.member, n.name, min(m.s) AS first_start, max(m.term_no) AS last_term FROM members n
        JOIN services m ON m.member = n.member AND m.house = 'dail' GROUP BY n.code, n.member, n.name""",
    "q03_previous_service": """
        SELECT n.member, max(CASE WHEN m.term_no = 5 THEN 1 ELSE 0 END) = 1 AS served
        FROM members n LEFT JOIN services m ON m.member = n.member AND m.house = 'dail' GROUP BY n.member""",
    "q08_seanad_entry": """
        SELECT member, min(s) AS first_start, count(*) - 1 AS later_episodes, min(constituency) AS panel
        FROM services WHERE house = 'seanad' GROUP BY member""",
    "q10_bill_lookup": """
        SELECT b.bill, b.status, b.kind, a.stage_no, a.activity_type, a.activity_date
        FROM bills b LEFT JOIN activities a ON a.bill = b.bill""",
    "q13_title_search": """
        SELECT concept, label FROM concepts WHERE label LIKE '%that%' AND label LIKE '%and%'""",
    "q15_bill_sponsors": """
        SELECT bill, sponsor, count(*) AS participations, max(CASE WHEN is_primary THEN 1 ELSE 0 END) AS is_primary,
               CASE WHEN count(DISTINCT is_primary) > 1 THEN 'conflicting' ELSE 'consistent' END AS flag
        FROM participations GROUP BY bill, sponsor""",
    "q17_refusals": """
        SELECT 'committee_chair' AS question, 'no chair is recorded' AS reason, 0 AS n
        UNION ALL SELECT 'committee_conflict', 'members of several committees at once', count(*) FROM (
            SELECT member FROM committee_memberships WHERE e IS NULL GROUP BY member HAVING count(DISTINCT committee) > 1) t
        UNION ALL SELECT 'bill_votes', 'votes are not linked with bills', count(*) FROM bills
        UNION ALL SELECT 'debate_transcript', 'texts are not answers', count(*) FROM components
        UNION ALL SELECT 'office_current_coverage', 'several current holders', count(*) FROM (
            SELECT office FROM office_holdings WHERE e IS NULL GROUP BY office HAVING count(DISTINCT member) > 1) u""",
    "q18_seats": "SELECT term_no, count(DISTINCT constituency) AS constituencies, count(DISTINCT member) AS seats FROM services WHERE house = 'dail' GROUP BY term_no",
    "q20_sittings": """
        SELECT day, body, count(DISTINCT sitting) AS sittings, count(DISTINCT record) AS records FROM sittings GROUP BY day, body""",
    "q21_previous_constituency": """
        SELECT DISTINCT m.constituency, k.name, m.member FROM services m JOIN constituencies k ON k.constituency = m.constituency
        WHERE m.house = 'dail' AND m.term_no = (SELECT max(term_no) - 1 FROM house_terms)""",
    "q24_composition": """
        SELECT a.constituency, count(DISTINCT a.member) AS both_terms
        FROM (SELECT DISTINCT member, constituency FROM memberships WHERE term_no = 3) a
        JOIN (SELECT DISTINCT member FROM memberships WHERE term_no = 4) b ON b.member = a.member
        WHERE a.constituency IN (1, 2, 3, 4) GROUP BY a.constituency""",
    "q28_seanad_after_dail": f"""
        SELECT DISTINCT n.member FROM (SELECT * FROM services WHERE house = 'seanad' AND {IN_FORCE}) n
        JOIN services d ON d.member = n.member AND d.house = 'dail' AND d.e IS NOT NULL AND d.e < n.s""",
    "q29_latest_representation": """
        SELECT member, constituency, s FROM (SELECT member, constituency, s,
               row_number() OVER (PARTITION BY member ORDER BY s DESC, id DESC) AS place,
               count(*) OVER (PARTITION BY member, s) AS same FROM memberships) t WHERE place = 1 AND same = 1""",
    "q30_office_points": """
        SELECT office, office_type, member, s, e FROM office_holdings
        WHERE s < DATE '1998-03-31' + 1 AND (e IS NULL OR e >= DATE '1998-03-01') AND (e IS NULL OR s <= e)""",
    "q36_kernel_counts": f"""
        SELECT r.constituency, p.party, count(DISTINCT r.member) AS members
        FROM (SELECT * FROM memberships WHERE {IN_FORCE}) r
        JOIN (SELECT id, member, party FROM memberships WHERE ps <= {AS_OF} AND (pe IS NULL OR {AS_OF} <= pe)) p
          ON p.member = r.member AND p.id = r.id GROUP BY r.constituency, p.party""",
    "q16_sponsor_rollup": """
        SELECT sponsor, count(DISTINCT bill) AS bills, count(DISTINCT CASE WHEN is_primary THEN bill END) AS primary_bills,
               count(DISTINCT bill_flags) AS flag_kinds, CASE WHEN min(bill_flags) = 2 THEN 'conflicting' WHEN max(bill_flags) = 2 THEN 'partly conflicting' ELSE 'consistent' END AS flags,
               CASE WHEN max(CASE WHEN is_primary THEN 1 ELSE 0 END) = 1 AND min(CASE WHEN is_primary THEN 1 ELSE 0 END) = 0 THEN 'primary, secondary'
                    WHEN max(CASE WHEN is_primary THEN 1 ELSE 0 END) = 1 THEN 'primary' ELSE 'secondary' END AS roles
        FROM (SELECT p.bill, p.sponsor, p.is_primary, f.n AS bill_flags FROM participations p
              JOIN (SELECT bill, sponsor, count(DISTINCT is_primary) AS n FROM participations GROUP BY bill, sponsor) f ON f.bill = p.bill AND f.sponsor = p.sponsor) t
        GROUP BY sponsor""",
    "q26_anchored_office": """
        SELECT a.member AS anchor, o.member, h.office, greatest(a.s, o.s, h.s) AS overlap_start,
               nullif(least(coalesce(a.e, DATE '9999-12-31'), coalesce(o.e, DATE '9999-12-31'), coalesce(h.e, DATE '9999-12-31')), DATE '9999-12-31') AS overlap_end,
               count(*) AS evidence
        FROM (SELECT DISTINCT member, id, term_no, constituency, party, s, e FROM memberships WHERE member IN (1, 2, 3, 4, 5) AND (e IS NULL OR s <= e)) a
        JOIN (SELECT * FROM memberships WHERE e IS NULL OR s <= e) o
          ON o.term_no = a.term_no AND o.constituency = a.constituency AND o.member <> a.member
        JOIN (SELECT * FROM office_holdings WHERE e IS NULL OR s <= e) h ON h.member = o.member
        WHERE greatest(a.s, o.s, h.s) <= least(coalesce(a.e, DATE '9999-12-31'), coalesce(o.e, DATE '9999-12-31'), coalesce(h.e, DATE '9999-12-31'))
        GROUP BY a.member, o.member, h.office, greatest(a.s, o.s, h.s),
                 nullif(least(coalesce(a.e, DATE '9999-12-31'), coalesce(o.e, DATE '9999-12-31'), coalesce(h.e, DATE '9999-12-31')), DATE '9999-12-31')""",
    "a23_coverage": """
        SELECT d.source, d.lang, count(*) AS documents, count(l.doc_id) AS labelled, sum(coalesce(l.quality, 0)) AS accepted,
               round(CAST(100 AS DOUBLE) * count(l.doc_id) / count(*), 6) AS coverage, round(CAST(sum(coalesce(l.quality, 0)) AS DOUBLE) / count(*), 6) AS density,
               sum(CASE WHEN l.doc_id IS NULL THEN 1 ELSE 0 END) AS abstained
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.source, d.lang""",
}
