"""The registered queries in SQL, over the same tables, for an independent check."""

from __future__ import annotations

SPLIT_HASH = "('0x' || substr(md5(concat_ws('|', cast({0} as varchar){1})), 1, 8))::bigint"
ROW_HASH = SPLIT_HASH.format("userId", ", cast(movieId as varchar)")
USER_HASH = SPLIT_HASH.format("userId", "")
WEEK = '("timestamp" + 43200) - (("timestamp" + 43200) % 604800) + 259200'
YEAR = r"cast(nullif(regexp_extract({t}, '\((\d{{4}})\)', 1), '') as integer)"
BARE_TITLE = r"regexp_replace({t}, '\s*\(\d{{4}}\)', '')"

RATINGS = """
ratings as (
  select cast(o_custkey as integer) as userId, cast(l_partkey as integer) as movieId,
         max(((l_quantity - 1) % 10 + 1) / 2) as rating,
         min(cast(epoch(o_orderdate) as bigint) + (l_orderkey * 7919) % 86400) as "timestamp"
  from lineitem join orders on l_orderkey = o_orderkey
  group by o_custkey, l_partkey)"""
MOVIES = """
movies as (
  select cast(p_partkey as integer) as movieId,
         case when p_partkey % 97 = 0 then p_name
              when p_partkey % 89 = 0 then concat(p_name, ' (1984) (2001)')
              else concat(p_name, ' (', cast(1950 + p_partkey % 60 as varchar), ')')
         end as title,
         concat(p_type, '|', replace(p_name, ' ', '|')) as genres
  from part)"""
FACT = f"""{RATINGS},{MOVIES},
enriched as (
  select r.userId, r.movieId, r.rating, r."timestamp", m.title, m.genres
  from ratings r left join movies m on r.movieId = m.movieId),
candidates as (select * from enriched where ({ROW_HASH}) % 10 = 0),
rest as (select * from enriched where ({ROW_HASH}) % 10 <> 0),
holdout0 as (
  select * from candidates
  where movieId in (select movieId from rest) and userId in (select userId from rest)),
removed as (select * from candidates except all select * from holdout0),
train0 as (select * from rest union all select * from removed),
train as (
  select userId, movieId, rating, "timestamp", {BARE_TITLE.format(t='title')} as title, genres,
         {YEAR.format(t='title')} as year, {WEEK} as week from train0),
holdout as (
  select userId, movieId, rating, "timestamp", {BARE_TITLE.format(t='title')} as title, genres,
         {YEAR.format(t='title')} as year, {WEEK} as week from holdout0)"""
EFFECTS = f"""{FACT},
mu as (select avg(rating) as mu from train),
bi as (select movieId, avg(rating - mu) as b_i from train, mu group by movieId),
bu as (select userId, avg(rating - mu - b_i) as b_u
       from train join bi using (movieId), mu group by userId),
res as (select genres, year, week, rating - mu - b_i - b_u as r
        from train join bi using (movieId) join bu using (userId), mu),
bg as (select genres, avg(r) as b_g from res group by genres),
by_ as (select year, avg(r) as b_y from res group by year),
bt as (select week, avg(r) as b_t from res group by week),
scored as (
  select h.*, mu, b_i, b_u, b_g, b_y, b_t from holdout h
  left join bi on h.movieId = bi.movieId
  left join bu on h.userId = bu.userId
  left join bg on h.genres is not distinct from bg.genres
  left join by_ on h.year is not distinct from by_.year
  left join bt on h.week = bt.week, mu)"""


# Some rows moved to a user, a movie or a week of their own.
REKEYED = f"""{RATINGS.replace("ratings as", "plain as")},
hashed as (select *, {ROW_HASH} as h from plain),
ratings as (
  select cast(case when h % 50 = 7 then 2000000 + h % 100000000 else userId end as integer) as userId,
         cast(case when h % 50 = 8 then 2000000 + h % 100000000 else movieId end as integer) as movieId,
         rating, case when h % 50 = 9 then "timestamp" + 604800 * (2000 + h % 500) else "timestamp" end as "timestamp"
  from hashed)"""


def with_(ctes: str, body: str) -> str:
    return f"with {ctes}\n{body}"


def rmse_of(method: str, pred: str, source: str = "scored") -> str:
    return f"""select '{method}' as method, count(*) as n,
  count(*) - count({pred}) as n_null,
  round(case when count(*) = count({pred}) then sqrt(avg(power(rating - ({pred}), 2))) end, 6) as rmse
from {source}"""


EFFECT_PREDICTIONS = {
    "effect_mu": ("Mu", "mu"),
    "effect_movie": ("Movie Effect", "mu + b_i"),
    "effect_movie_user": ("Movie + User Effects", "mu + b_i + b_u"),
    "effect_time": ("Movie + User + Time Effects", "mu + b_i + b_u + b_t"),
    "effect_genre": ("Movie + User + Genre Effects", "mu + b_i + b_u + b_g"),
    "effect_year": ("Movie + User + Year Effects", "mu + b_i + b_u + b_y"),
    "effect_all": (
        "Movie + User + Time + Genre + Year Effects", "mu + b_i + b_u + b_g + b_t + b_y",
    ),
}


def effect_queries() -> dict[str, str]:
    single = {k: with_(EFFECTS, rmse_of(m, p)) for k, (m, p) in EFFECT_PREDICTIONS.items()}
    every = "\nunion all\n".join(rmse_of(m, p) for m, p in EFFECT_PREDICTIONS.values())
    return {
        **single,
        "rmse_all_effects": with_(EFFECTS, every),
        "result_roundtrip": with_(EFFECTS, every),
    }


LAMBDAS = "(select i * 0.25 as penalty from range(0, 41) t(i))"
TUNING = f"""{FACT},
fit as (select * from train where (({ROW_HASH}) // 10) % 10 <> 0),
valid as (
  select * from train where (({ROW_HASH}) // 10) % 10 = 0
  and movieId in (select movieId from fit) and userId in (select userId from fit))"""


def sweep_ctes(train: str, holdout: str, chain: list[str], tag: str) -> str:
    """Penalised effects for every penalty: the first key, then the others on its residual."""
    first, *others = chain
    effects = [f"""mu_{tag} as (select avg(rating) as mu from {train}),
    l_{tag} as {LAMBDAS},
    e0_{tag} as (select penalty, {first}, sum(rating - mu) / (count(*) + penalty) as e0
                from {train}, mu_{tag}, l_{tag} group by penalty, {first})"""]
    for i, key in enumerate(others, 1):
        effects.append(f"""e{i}_{tag} as (
        select penalty, t.{key}, sum(rating - mu - e0) / (count(*) + penalty) as e{i}
        from {train} t join e0_{tag} using ({first}), mu_{tag} group by penalty, t.{key})""")
    joins = " ".join(
        f"left join e{i}_{tag} on e{i}_{tag}.penalty = l_{tag}.penalty and e{i}_{tag}.{key} is not distinct from h.{key}"
        for i, key in enumerate(chain))
    pred = " + ".join(["mu", *[f"e{i}" for i in range(len(chain))]])
    effects.append(f"""sweep_{tag} as (
    select l_{tag}.penalty as penalty, count(*) as n, count(*) - count({pred}) as n_null,
           case when count(*) = count({pred}) then sqrt(avg(power(rating - ({pred}), 2))) end as rmse
    from {holdout} h cross join l_{tag} cross join mu_{tag} {joins} group by 1)""")
    return ",\n".join(effects)


CHAINS = {
    "movie_user": ("Regularised Movie + User Effect", ["movieId", "userId"]),
    "user_movie": ("Regularised User + Movie Effect", ["userId", "movieId"]),
    "all": (
        "Regularised Movie + User + Time + Genre + Year Effect",
        ["movieId", "userId", "genres", "year", "week"],
    ),
}


def regularised_queries() -> dict[str, str]:
    out = {}
    for name, (_, chain) in CHAINS.items():
        out[f"reg_{name}"] = with_(f"{FACT},\n{sweep_ctes('train', 'holdout', chain, 's')}", """
        select penalty, n, n_null, round(rmse, 6) as rmse,
               row_number() over (order by round(rmse, 9), penalty) = 1 as is_best from sweep_s""")
    tuning, rows = [TUNING], []
    for name, (method, chain) in CHAINS.items():
        tuning.append(sweep_ctes("fit", "valid", chain, f"v_{name}"))
        tuning.append(sweep_ctes("train", "holdout", chain, f"h_{name}"))
        rows.append(f"""select '{method}' as method, penalty, n, n_null, round(rmse, 6) as rmse
        from sweep_h_{name} where penalty = (
          select penalty from sweep_v_{name} order by round(rmse, 9), penalty limit 1)""")
    out["reg_validated"] = with_(",\n".join(tuning), "\nunion all\n".join(rows))
    every = "\nunion all\n".join(rmse_of(m, p) for m, p in EFFECT_PREDICTIONS.values())
    best, ctes = [], [EFFECTS]
    for name, (method, chain) in CHAINS.items():
        ctes.append(sweep_ctes("train", "holdout", chain, f"c_{name}"))
        best.append(f"""select * from (select '{method}' as method, n, n_null, round(rmse, 6) as rmse
        from sweep_c_{name} order by round(sweep_c_{name}.rmse, 9), penalty limit 1)""")
    out["model_comparison"] = with_(",\n".join(ctes), f"""
        select method as "Method", rmse as "RMSE", cast(null as double) as "Time (sec)",
        cast(null as double) as "Size (MB)" from ({every} union all {" union all ".join(best)})""")
    return out


def source_queries() -> dict[str, str]:
    plain = 'select userId, movieId, rating, "timestamp" from ratings'
    return {
        "parse_ratings_lines": with_(RATINGS, plain),
        "parse_movies_lines": with_(MOVIES, "select movieId, title, genres from movies"),
        "space_text_roundtrip": with_(RATINGS, "select userId as \"user\", movieId as item, rating from ratings"),
        "training_log_parse": with_(
            RATINGS,
            """select userId as iter, round(avg(rating), 4) as tr_rmse, sum(rating) as obj
            from ratings group by userId""",
        ),
        "ingest_repartitioned": with_(
            RATINGS, "select userId as \"user\", movieId as item, rating from ratings"
        ),
        "ingest_files": with_(
            RATINGS, 'select userId as "user", movieId as item, rating, "timestamp" from ratings'
        ),
        "prepare_ids": with_(
            RATINGS,
            """select userId as "user", movieId as item, rating from ratings
            where rating <> 0.5 and rating <> 5.0""",
        ),
    }


def explore_queries() -> dict[str, str]:
    def bars(key: str, at_least: int) -> str:
        return with_(FACT, f"""
        select {key}, n, round(avg, 6) as avg, round(se, 6) as se,
               round(avg - 2 * se, 6) as lower, round(avg + 2 * se, 6) as upper
        from (select {key}, count(*) as n, avg(rating) as avg,
                     stddev_samp(rating) / sqrt(count(*)) as se
              from train group by {key}) where n >= {at_least}""")

    def histogram(kind: str, key: str, x: str, where: str = "") -> str:
        return f"""
        select '{kind}' as kind, bin, round(min(lo + bin * width), 6) as bin_start,
               cast(count(*) as bigint) as frequency
        from (select lo, width, cast(case when width = 0 then 0
                     else least(floor((x - lo) / width), 29) end as integer) as bin
              from (select {x} as x, min({x}) over () as lo,
                           (max({x}) over () - min({x}) over ()) / 30 as width
                    from (select count(*) as n from train group by {key}) {where}))
        group by bin"""

    as_double = "cast(n as double)"
    genre_rows = "select unnest(coalesce(string_split(genres, '|'), [null])) as genres from train"
    weekly = "select week, avg(rating) as rating from train group by week"
    dense_users = "select userId, dense_rank() over (order by userId) as idx from train"
    return {
        "title_year": with_(MOVIES, f"""
            select movieId, {BARE_TITLE.format(t='title')} as title,
                   {YEAR.format(t='title')} as year from movies"""),
        "star_class_counts": with_(FACT, """
            select case when rating in (1, 2, 3, 4, 5) then 'Whole Star' else 'Half Star' end
                   as ratings_group, count(*) as count from train group by 1"""),
        "rating_histogram": with_(FACT, """
            select floor(rating / 0.5) * 0.5 as bucket,
                   case when rating in (1, 2, 3, 4, 5) then 'Whole Star' else 'Half Star' end
                   as ratings_group, count(*) as count from train group by 1, 2"""),
        "top_genres": with_(FACT, f"select genres, count(*) as count from ({genre_rows}) group by genres"),
        "top5_genres": with_(FACT, f"""
            select genres, count(*) as count from ({genre_rows}) group by genres
            order by count desc, genres limit 5"""),
        "top_years": with_(FACT, "select year, count(*) as count from train group by year"),
        "top_titles": with_(FACT, "select title, count(*) as count from train group by title"),
        "top20_titles": with_(FACT, """
            select title, count from (
              select title, count(*) as count, rank() over (order by count(*) desc) as rk
              from train group by title) where rk <= 20"""),
        "genre_error_bars": bars("genres", 100),
        "year_error_bars": bars("year", 500),
        "distinct_counts": with_(FACT, """
            select count(distinct userId) as n_users, count(distinct movieId) as n_movies
            from train"""),
        "counts_per_movie": with_(FACT, "select movieId, count(*) as count from train group by movieId"),
        "counts_per_user": with_(FACT, "select userId, count(*) as count from train group by userId"),
        "support_histogram": with_(FACT, "\nunion all\n".join([
            histogram("movie", "movieId", as_double),
            histogram("movie below 40", "movieId", as_double, "where n < 40"),
            histogram("user", "userId", as_double)])),
        "support_histogram_log": with_(FACT, "\nunion all\n".join([
            histogram("movie", "movieId", "log10(n)"), histogram("user", "userId", "log10(n)")])),
        "weekly_mean_rating": with_(FACT, f"select week, round(rating, 6) as rating from ({weekly})"),
        "weekly_trend": with_(FACT, f"""
            select week, round(rating, 6) as rating, round(avg(rating) over (
              order by week range between 2419200 preceding and 2419200 following), 6) as trend
            from ({weekly})"""),
        "genre_mean_rating": with_(FACT, """
            select genres, round(avg(rating), 6) as rating from train group by genres"""),
        "year_mean_rating": with_(FACT, """
            select year, round(avg(rating), 6) as rating from train group by year"""),
        "filter_by_genre_support": with_(FACT, """
            select userId, movieId, rating, genres from train where genres in (
              select genres from train group by genres having count(*) > 100)"""),
        "cumulative_share": with_(FACT, """
            select movieId, count, round(sum(power(count, 2)) over (order by count desc, movieId
              rows unbounded preceding) / sum(power(count, 2)) over (), 6) as share
            from (select movieId, count(*) as count from train group by movieId)"""),
        "dense_ids": with_(FACT, f"""
            select distinct 'user' as kind, userId as id, idx from ({dense_users})
            union all
            select distinct 'movie', movieId, dense_rank() over (order by movieId) from train"""),
        "first_title_per_movie": with_(FACT, """
            select movieId, title, genres, year from (
              select *, row_number() over (partition by movieId order by title, genres, year) as rn
              from train) where rn = 1"""),
        "common_users_items": with_(FACT, """
            select 'user' as kind, userId as id from (
              select userId from train intersect select userId from holdout)
            union all
            select 'movie', movieId from (
              select movieId from train intersect select movieId from holdout)"""),
        "support_features": with_(FACT, "\nunion all\n".join(
            f"""select '{part}' as part, userId, movieId,
                  count(*) over (partition by userId) as n_movies_by_user,
                  count(*) over (partition by movieId) as n_users_by_movie from {part}"""
            for part in ("train", "holdout"))),
    }


def join_and_split_queries() -> dict[str, str]:
    six = 'userId, movieId, rating, "timestamp", title, genres'
    return {
        "ratings_enriched": with_(FACT, f"select {six} from enriched"),
        "holdout_consistent": with_(FACT, f"select {six} from holdout0"),
        "holdout_removed": with_(FACT, f"select {six} from removed"),
        "train_final": with_(FACT, f"select {six} from train0"),
        "holdout_split": with_(FACT, """
            select userId, movieId, false as holdout from train0
            union all select userId, movieId, true from holdout0"""),
        "dense_movie_join": with_(f"""{FACT},
full_data as (select {six} from train0 union all select {six} from holdout0),
dense as (select movieId, row_number() over (order by movieId) as movieIdDense
          from (select distinct movieId from full_data))""", """
            select f.userId, d.movieIdDense, f.rating, f.title, f.genres
            from full_data f join dense d using (movieId)"""),
        "stratified_exact": with_(RATINGS, f"""
            select userId, movieId, rating from (
              select *, row_number() over (partition by rating order by h, userId, movieId) as rn,
                     ceil(count(*) over (partition by rating) * 0.1) as want
              from (select *, {ROW_HASH} as h from ratings)) where rn <= want"""),
        "known_unknown_split": with_(FACT, f"""
            select userId, movieId, case when ({USER_HASH}) % 100 < 60 then 'train'
                   when rn <= 2 then 'unknown' else 'known' end as part
            from (select *, row_number() over (partition by userId order by h, movieId) as rn
                  from (select *, {ROW_HASH} as h from train))"""),
        "kfold_counts": with_(FACT, "\nunion all\n".join(
            f"""select {k} as folds, (({ROW_HASH}) // 10) % {k} as fold, count(*) as n,
                round(sum(rating), 6) as sum_rating from train group by 2"""
            for k in (3, 20))),
    }


def matrix_queries() -> dict[str, str]:
    dense = f"""{FACT},
    cells as (select dense_rank() over (order by userId) as u,
                     dense_rank() over (order by movieId) as i, rating as x from train)"""

    def pairs(col: str, row: str, norm: str) -> str:
        length = "sqrt(sum(a.rating * a.rating)) * sqrt(sum(b.rating * b.rating))"
        if norm == "full":
            length = "min(la.length) * min(lb.length)"
        return with_(f"""{FACT}, lengths as (
        select {col} as id, sqrt(sum(rating * rating)) as length from train group by {col})""", f"""
        select a.{col} as i, b.{col} as j, round(sum(a.rating * b.rating) / ({length}), 9) as sim
        from train a join train b on a.{row} = b.{row} and a.{col} < b.{col}
        join lengths la on la.id = a.{col} join lengths lb on lb.id = b.{col} group by 1, 2""")

    return {
        "rating_matrix": with_(dense, "select u, i, sum(x) as x from cells group by u, i"),
        "matrix_block": with_(dense, """
            select u, i, sum(x) as x from cells where u <= 10 and i <= 10 group by u, i"""),
        "svd_invariant": with_(dense, "select round(sum(x * x), 6) as total from cells where u <= 40 and i <= 40"),
        "user_cosine": pairs("userId", "movieId", "full"),
        "item_cosine": pairs("movieId", "userId", "full"),
        "item_cosine_corated": pairs("movieId", "userId", "corated"),
        "relevant_ratings": with_(FACT, """
            select userId, movieId, rating from train
            where userId in (select userId from train group by userId having count(*) > (
                select round_even(quantile_cont(n, 0.90), 0) from (
                  select cast(count(*) as double) as n from train group by userId)))
              and movieId in (select movieId from train group by movieId having count(*) > (
                select round_even(quantile_cont(n, 0.75), 0) from (
                  select cast(count(*) as double) as n from train group by movieId)))"""),
    }


CF = f"""{FACT},
numbered as (select *, row_number() over (partition by userId order by h, movieId) as rn
             from (select *, {ROW_HASH} as h from train)),
parts as (select userId, movieId, rating,
                 case when ({USER_HASH}) % 100 < 60 then 'train'
                      when rn <= 2 then 'unknown' else 'known' end as part from numbered),
means as (select userId, avg(rating) as mean from parts where part <> 'unknown' group by userId),
seen as (select p.*, mean, rating - mean as c from parts p join means using (userId)
         where part <> 'unknown'),
hidden as (select p.userId, p.movieId, p.rating, mean from parts p
           left join means using (userId) where part = 'unknown'),
overall as (select avg(rating) as mean_all from parts where part = 'train'),
trained as (select * from seen where part = 'train'),
known as (select * from seen where part = 'known')"""


def neighbour_queries(k: int = 350) -> dict[str, str]:
    hidden = "select h.userId, h.movieId, h.rating, round(coalesce(h.mean, mean_all)"
    centred = f"""{FACT},
    means as (select userId, avg(rating) as mean from train group by userId),
    c as (select t.userId, t.movieId, t.rating - mean as c from train t join means using (userId)),
    devs as (select a.movieId as i, b.movieId as j, count(*) as cnt, avg(a.c - b.c) as dev
             from c a join c b on a.userId = b.userId and a.movieId <> b.movieId group by 1, 2)"""

    def pairs_of(column: str, row: str) -> str:
        return f"""
                select a.{column} as i, b.{column} as j, round(sum(a.c * b.c) / (min(la.len) * min(lb.len)), 9) as sim
                from c a join c b on a.{row} = b.{row} and a.{column} <> b.{column}
                join (select {column} as id, sqrt(sum(c * c)) as len from c group by 1) la on la.id = a.{column} and la.len > 0
                join (select {column} as id, sqrt(sum(c * c)) as len from c group by 1) lb on lb.id = b.{column} and lb.len > 0
                group by 1, 2"""

    def nearest(column: str, row: str, k: int = k) -> str:
        return with_(centred, f"""
            select i, j, sim from (
              select *, row_number() over (partition by i order by sim desc, j) as rk from ({pairs_of(column, row)}) where sim > 0) where rk <= {k}""")

    def similar(column: str, row: str, least: float = 0.3) -> str:
        return with_(centred, f"select i, j, sim from ({pairs_of(column, row)}) where i < j and sim >= {least}")

    return {
        "item_neighbours": nearest("movieId", "userId"),
        "user_neighbours": nearest("userId", "movieId"),
        "similar_movies": similar("movieId", "userId"),
        "similar_users": similar("userId", "movieId"),
        "similar_nearest_users": nearest("userId", "movieId", 10),
        "center_ratings": with_(FACT, """
            select userId, movieId, rating, round(avg(rating) over (partition by userId), 6) as mean,
                   round(rating - avg(rating) over (partition by userId), 6) as centred from train"""),
        "cf_popular": with_(f"""{CF},
        item as (select movieId, avg(c) as b from trained group by movieId)""", f"""
            {hidden} + coalesce(b, 0), 6) as pred
            from hidden h left join item using (movieId), overall"""),
        "cf_user_based": with_(f"""{CF},
        len as (select userId, sqrt(sum(c * c)) as len from seen group by userId),
        dots as (select a.userId as u, b.userId as v, sum(a.c * b.c) as dot
                 from known a join trained b using (movieId) group by 1, 2),
        sims as (select u, v, round(dot / (lu.len * lv.len), 9) as sim from dots
                 join len lu on lu.userId = u join len lv on lv.userId = v
                 where lu.len > 0 and lv.len > 0),
        nearest as (select * from (select *, row_number() over (
                      partition by u order by sim desc, v) as rk from sims where sim > 0)
                    where rk <= {k}),
        votes as (select h.userId, h.movieId, sum(sim * t.c) / sum(sim) as b from hidden h
                  join nearest on u = h.userId join trained t on t.userId = v
                  and t.movieId = h.movieId group by 1, 2)""", f"""
            {hidden} + coalesce(b, 0), 6) as pred
            from hidden h left join votes using (userId, movieId), overall"""),
        "cf_item_based": with_(f"""{CF},
        len as (select movieId, sqrt(sum(c * c)) as len from trained group by movieId),
        dots as (select a.movieId as i, b.movieId as j, sum(a.c * b.c) as dot
                 from trained a join trained b on a.userId = b.userId and a.movieId <> b.movieId
                 group by 1, 2),
        sims as (select i, j, round(dot / (li.len * lj.len), 9) as sim from dots
                 join len li on li.movieId = i join len lj on lj.movieId = j
                 where li.len > 0 and lj.len > 0),
        nearest as (select * from (select *, row_number() over (
                      partition by i order by sim desc, j) as rk from sims where sim > 0)
                    where rk <= {k}),
        votes as (select h.userId, h.movieId, sum(sim * n.c) / sum(sim) as b from hidden h
                  join nearest on i = h.movieId join known n on n.userId = h.userId
                  and n.movieId = j group by 1, 2)""", f"""
            {hidden} + coalesce(b, 0), 6) as pred
            from hidden h left join votes using (userId, movieId), overall"""),
        "slope_one_deviations": with_(centred, """
            select i, j, cast(cnt as bigint) as cnt, round(dev, 6) as dev from devs where i < j"""),
        "slope_one": with_(f"""{centred},
        votes as (select h.userId, h.movieId, sum(cnt * (dev + c.c)) / sum(cnt) as b
                  from holdout h join c on c.userId = h.userId
                  join devs on i = h.movieId and j = c.movieId group by 1, 2)""", """
            select h.userId, h.movieId, h.rating, round(mean + coalesce(b, 0), 6) as pred
            from holdout h left join means using (userId)
            left join votes v on v.userId = h.userId and v.movieId = h.movieId"""),
    }


SPLIT_SALTED = SPLIT_HASH.format("userId", ", cast(movieId as varchar), '{salt}'")


def further_queries() -> dict[str, str]:
    neighbours = neighbour_queries()
    relevant = """relevant as (
      select * from train
      where userId in (select userId from train group by userId having count(*) > (
          select round_even(quantile_cont(n, 0.90), 0) from (
            select cast(count(*) as double) as n from train group by userId)))
        and movieId in (select movieId from train group by movieId having count(*) > (
          select round_even(quantile_cont(n, 0.75), 0) from (
            select cast(count(*) as double) as n from train group by movieId)))),
    numbered as ("""
    errors = []
    for method, name in (("popular", "cf_popular"), ("user based", "cf_user_based"), ("item based", "cf_item_based")):
        inner = neighbours[name].replace("numbered as (", relevant, 1).replace(" as h from train)", " as h from relevant)", 1)
        inner = inner.replace(", 6) as pred", ", 12) as pred")
        errors.append(f"""select '{method}' as method, count(*) as n, count(*) - count(pred) as n_null,
          round(sqrt(avg(power(rating - pred, 2))), 6) as rmse from ({inner})""")
    splits = []
    for name, limit, salt in (("70/30", 700, "trees"), ("90/10", 900, "latent")):
        h = SPLIT_SALTED.format(salt=salt)
        splits.append(f"""select '{name}' as split, case when ({h}) % 1000 < {limit} then 'first' else 'second' end as side,
          userId, movieId from train""")
    six = 'userId, movieId, rating, "timestamp", title, genres'
    picks = []
    for among, pairs in (
        ("all", "select u.userId, i.movieId, mu + b_u + b_i as score from bu u, bi i, mu"),
        ("unseen", """select u.userId, i.movieId, mu + b_u + b_i as score from bu u cross join bi i cross join mu
                      anti join train t on t.userId = u.userId and t.movieId = i.movieId"""),
    ):
        for pick, order in (("top", "desc"), ("bottom", "asc")):
            picks.append(f"""select '{among}' as among, userId, '{pick}' as pick, cast(rank as integer) as rank, movieId,
              round_even(score, 2) as predicted_rating from (
                select *, row_number() over (partition by userId order by round(score, 9) {order}, movieId) as rank
                from ({pairs})) where rank <= 10""")
    rekeyed_fact, rekeyed_effects = (text.replace(RATINGS, REKEYED, 1) for text in (FACT, EFFECTS))
    timed = "mu + b_i + b_u + b_t"
    name = EFFECT_PREDICTIONS["effect_time"][0]
    modes = {
        "strict": f"case when count(*) = count({timed}) then sqrt(avg(power(rating - ({timed}), 2))) end",
        "skip": f"sqrt(avg(power(rating - ({timed}), 2)))",
        "zero": "sqrt(avg(power(rating - (mu + coalesce(b_i, 0) + coalesce(b_u, 0) + coalesce(b_t, 0)), 2)))",
    }
    return {
        "cf_rmse": "\nunion all\n".join(errors),
        "share_splits": with_(FACT, "\nunion all\n".join(splits)),
        "picked_user": with_(FACT, f"""
            select (select count(*) from holdout) as rows, userId from holdout order by {USER_HASH}, userId limit 1"""),
        "rating_range": with_(FACT, "select min(rating) as least, max(rating) as most from train"),
        "recommend_batch": with_(EFFECTS, "\nunion all\n".join(picks)),
        "recommend_pruned": with_(EFFECTS, "\nunion all\n".join(picks)),
        "factor_score_effects": with_(EFFECTS, """
            select userId, movieId, rating, round(b_u + mu + b_i, 6) as pred from scored"""),
        "rekeyed_removed": with_(rekeyed_fact, f"select {six} from removed"),
        "rekeyed_anti_join": with_(rekeyed_fact, f"select {six} from removed"),
        "rekeyed_holdout": with_(rekeyed_fact, """
            select userId, movieId, false as holdout from train0
            union all select userId, movieId, true from holdout0"""),
        "rekeyed_effect_time": with_(rekeyed_effects, "\nunion all\n".join(
            f"""select '{mode}' as missing, '{name}' as method, count(*) as n,
              {"0" if mode == "zero" else f"count(*) - count({timed})"} as n_null,
              round({value}, 6) as rmse from scored""" for mode, value in modes.items())),
        "rekeyed_top_genres": with_(rekeyed_fact, """
            select genres, count(*) as count from (
              select unnest(coalesce(string_split(genres, '|'), [null])) as genres from train) group by genres"""),
    }


def serving_queries(k: int = 10) -> dict[str, str]:
    ranked = " union all ".join(
        f"""select * from (select '{pick}' as pick, row_number() over (
              order by round(b_i, 9) {order}, movieId) as rank, movieId, b_i from bi) where rank <= {k}"""
        for pick, order in (("top", "desc"), ("bottom", "asc")))
    return {
        "recommend_effects": with_(f"""{EFFECTS},
        titles as (select distinct movieId, title, genres, year from train),
        picks as ({ranked})""", """
            select userId, pick, cast(rank as integer) as rank, movieId,
                   round_even(mu + b_u + b_i, 2) as predicted_rating, title, genres, year
            from bu cross join picks join titles using (movieId), mu"""),
    }


def fitted_queries(k: int = 350) -> dict[str, str]:
    """The exact parts of the model queries: encodings, coverage, biases, blends, saved models."""
    fold = f"cast((({ROW_HASH}) // 10) % 3 as integer)"
    inputs = f"""{FACT},
    rows as (select userId, movieId, rating, {fold} as fold from train
             where ({SPLIT_SALTED.format(salt='trees')}) % 1000 < 700),
    overall as (select avg(rating) as mu from rows),
    encoded as (select userId, movieId, rating, fold, """ + ", ".join(
        f"""(sum(rating) over (partition by {key}) - sum(rating) over (partition by {key}, fold) + 5 * mu)
            / (count(*) over (partition by {key}) - count(*) over (partition by {key}, fold) + 5) as te_{key}"""
        for key in ("movieId", "userId")) + " from rows, overall)"
    sums = """sums as (select count(*) as n, avg(te_movieId) as mx, avg(te_userId) as mz, avg(rating) as my,
        covar_pop(te_movieId, te_movieId) as xx, covar_pop(te_userId, te_userId) as zz,
        covar_pop(te_movieId, te_userId) as xz, covar_pop(te_movieId, rating) as xy,
        covar_pop(te_userId, rating) as zy from encoded),
    solved as (select *, (xy * zz - zy * xz) / (xx * zz - xz * xz) as wx,
                      (zy * xx - xy * xz) / (xx * zz - xz * xz) as wz from sums)"""
    squares = """sums as (select blend, term2, sum(x * x) as xx, sum(z * z) as zz, sum(x * z) as xz,
                                 sum(x * rating) as xy, sum(z * rating) as zy
      from (select 'both' as blend, 'te_userId' as term2, te_movieId as x, te_userId as z, rating from encoded
            union all select 'one', 'turned', te_movieId, -te_userId, rating from encoded) group by blend, term2),
    free as (select *, (xy * zz - zy * xz) / (xx * zz - xz * xz) as fx,
                    (zy * xx - xy * xz) / (xx * zz - xz * xz) as fz from sums),
    solved as (select blend, term2,
        case when fx >= 0 and fz >= 0 then fx
             when greatest(xy, 0) * greatest(xy, 0) / xx >= greatest(zy, 0) * greatest(zy, 0) / zz
             then greatest(xy, 0) / xx else 0 end as wx,
        case when fx >= 0 and fz >= 0 then fz
             when greatest(xy, 0) * greatest(xy, 0) / xx >= greatest(zy, 0) * greatest(zy, 0) / zz
             then 0 else greatest(zy, 0) / zz end as wz from free)"""
    logit = f"""{FACT},
    everything as (select userId, movieId, rating from train union all select userId, movieId, rating from holdout),
    part as (select * from everything where ({SPLIT_SALTED.format(salt='latent')}) % 1000 < 900),
    ends as (select min(rating) as lo, max(rating) as hi from part),
    placed as (select userId, movieId, greatest(0.05, least(0.95, (rating - lo) / (hi - lo))) as share from part, ends),
    odds as (select userId, movieId, ln(share / (1 - share)) as rating from placed),
    mu as (select avg(rating) as mu from odds),
    bi as (select movieId, avg(rating - mu) as b_i from odds, mu group by movieId),
    bu as (select userId, avg(rating - mu - b_i) as b_u from odds join bi using (movieId), mu group by userId)"""
    folds = f"""{FACT},
    rows as (select userId, movieId, rating, {fold} as fold from train),
    cases as (select f as out, penalty from (values (0), (1), (2)) a(f), (values (0.0), (2.0), (5.0), (10.0)) b(penalty)),
    inside as (select out, cast(penalty as double) as penalty, userId, movieId, rating from cases join rows on fold <> out),
    mus as (select out, penalty, avg(rating) as mu from inside group by 1, 2),
    bis as (select out, penalty, movieId, sum(rating - mu) / (count(*) + penalty) as b_i
            from inside join mus using (out, penalty) group by 1, 2, 3),
    bus as (select out, penalty, userId, sum(rating - mu - b_i) / (count(*) + penalty) as b_u
            from inside join mus using (out, penalty) join bis using (out, penalty, movieId) group by 1, 2, 3),
    errors as (select m.out, m.penalty,
                      sqrt(avg(power(r.rating - mu - coalesce(b_i, 0) - coalesce(b_u, 0), 2))) as e
               from rows r join mus m on m.out = r.fold
               left join bis i on i.out = m.out and i.penalty = m.penalty and i.movieId = r.movieId
               left join bus u on u.out = m.out and u.penalty = m.penalty and u.userId = r.userId group by 1, 2),
    tuned as (select penalty, avg(e) as e from errors group by penalty)"""
    near = f"""{FACT},
    means as (select userId, avg(rating) as mean from train group by userId),
    c as (select t.userId, movieId, rating - mean as c from train t join means using (userId)),
    len as (select movieId, sqrt(sum(c * c)) as len from c group by movieId),
    dots as (select a.movieId as i, b.movieId as j, sum(a.c * b.c) as dot
             from c a join c b on a.userId = b.userId and a.movieId <> b.movieId group by 1, 2),
    sims as (select i, j, round(dot / (li.len * lj.len), 9) as sim from dots
             join len li on li.movieId = i join len lj on lj.movieId = j where li.len > 0 and lj.len > 0),
    nearest as (select * from (select *, row_number() over (partition by i order by sim desc, j) as rk
                               from sims where sim > 0) where rk <= {k}),
    votes as (select h.userId, h.movieId, sum(sim * c.c) / sum(sim) as b from holdout h
              join nearest on i = h.movieId join c on c.userId = h.userId and c.movieId = j group by 1, 2)"""
    return {
        "tree_features": with_(inputs, """
            select userId, movieId, fold, round(te_movieId, 6) as te_movieId, round(te_userId, 6) as te_userId
            from encoded"""),
        "oof_coverage": with_(inputs, """
            select fold, count(*) as n, count(*) as n_gbt, count(*) as n_rf,
                   count(distinct (userId, movieId)) as n_pairs, round(sum(rating), 6) as sum_rating
            from rows group by fold"""),
        "stack_fixed": with_(f"{inputs}, {sums}", """
            select 'intercept' as term, round(my - wx * mx - wz * mz, 6) as weight from solved
            union all select 'te_movieId', round(wx, 6) from solved
            union all select 'te_userId', round(wz, 6) from solved"""),
        "stacked_nonnegative": with_(f"{inputs}, {squares}", """
            select blend, 'te_movieId' as term, round(wx, 6) as weight from solved
            union all select blend, term2, round(wz, 6) from solved"""),
        "latent_logit_biases": with_(logit, """
            select 'b_i' as kind, movieId as id, round(b_i, 6) as bias from bi
            union all select 'b_u', userId, round(b_u, 6) from bu"""),
        "effect_folds": with_(folds, """
            select penalty, round(e, 6) as rmse, e = (select min(e) from tuned) as best from tuned"""),
        "effect_roundtrip": with_(EFFECTS, "select userId, movieId, rating, round(mu + b_i + b_u, 6) as pred from scored"),
        "slope_one_roundtrip": neighbour_queries()["slope_one"],
        "item_model_roundtrip": with_(near, """
            select h.userId, h.movieId, h.rating,
                   round(coalesce(mean, (select avg(rating) from train)) + coalesce(b, 0), 6) as pred
            from holdout h left join means using (userId) left join votes using (userId, movieId)"""),
    }


def oracle_sql() -> dict[str, str]:
    return {
        **source_queries(),
        **explore_queries(),
        **join_and_split_queries(),
        **effect_queries(),
        **regularised_queries(),
        **matrix_queries(),
        **neighbour_queries(),
        **serving_queries(),
        **further_queries(),
        **fitted_queries(),
    }
